"""Run settings, held as frozen dataclasses on the driver.

The field names are those of the crawl's JSON settings files, so
``CrawlConfig(**json.load(f))`` works as is.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Defaults and markers that decide the results.
# ---------------------------------------------------------------------------

WORDS_TO_IGNORE = (
    "mailto:",
    "sms:",
    "mms:",
    "whatsapp:",
    "tel:",
    "slack.com",
    "www.audible.",
    "javscript",
    "javascript",
    "https://creativecommons.org",
    "drive.google.com",
    "ebela.in",
    "hungama.com",
    "hotstar.com",
    "audible.in",
    "www.apple.com",
    "www.amazon.",
    "speechtyping.com",
    "ieeexplore.ieee.org",
    "melody",
    "hangouts.google.com",
    "duo.google.com",
    "youtube.com",
    "books.google.co",
    "jiosavvn",
    "dl.acm.org",
    "fb-messenger:",
    "javscript",
    "instrument",
    "music",
    "onlineradiofm",
    "gaana.com",
    "spotify.com",
    "song",
    "skype",
    "javascript",
    "terms-and-conditions",
    "microsoft.com",
    "facebook",
    "instagram",
    "gmail",
    "pinterest",
    "reddit",
    "play.google.com",
    "ringtone",
    "twitter",
    "snapchat",
    "go.microsoft.com/fwlink",
    "www.microsofttranslator.com",
    "www.microsoft.com",
    "netflix.com",
    "amazon.in",
    "flipkart",
    "snapdeal",
    "mintra",
    "https://www.bing.com/videos/",
)

EXTENSIONS_TO_IGNORE = (
    ".jpeg",
    "xlsx",
    ".xls",
    ".docx",
    ".doc",
    ".jpg",
    ".png",
    ".torrent",
    ".gif",
    ".pdf",
    ".zip",
    ".oga",
    ".rar",
    ".rm",
    ".dmg",
    ".xml",
)

MEDIA_EXTENSIONS = (".mp3", ".wav", ".ogg", ".mp4", ".m4a")

# Suffixes a general-purpose link crawler skips by default (written without a dot).
CRAWLER_IGNORED_EXTENSIONS = (
    # archives
    "7z", "7zip", "bz2", "rar", "tar", "tar.gz", "xz", "zip",
    # images
    "mng", "pct", "bmp", "gif", "jpg", "jpeg", "png", "pst", "psp", "tif", "tiff",
    "ai", "drw", "dxf", "eps", "ps", "svg", "cdr", "ico",
    # audio
    "mp3", "wma", "ogg", "wav", "ra", "aac", "mid", "au", "aiff",
    # video
    "3gp", "asf", "asx", "avi", "mov", "mp4", "mpg", "qt", "rm", "swf", "wmv", "m4a",
    "m4v", "flv", "webm",
    # office suites
    "xls", "xlsx", "ppt", "pptx", "pps", "doc", "docx", "odt", "ods", "odg", "odp",
    # other
    "css", "pdf", "exe", "bin", "rss", "dmg", "iso", "apk",
)

WIKI_DOMAINS = ("wikipedia.org", "wikimedia.org")
WIKI_PREFIXES = ("en", "wiki")

SEARCH_BLOCKED_HOSTS = ("go.microsoft.com", "microsofttranslator.com")
SEARCH_ENDPOINT = "https://www.bing.com/search?q="
RESULTS_PER_SEARCH_PAGE = 10

CC_URL_PREFIXES = (
    "https://creativecommons.org/publicdomain/mark",
    "https://creativecommons.org/publicdomain/zero",
    "https://creativecommons.org/licenses/by",
)
LICENSE_TERMS = (
    "terms",
    "license",
    "copyright",
    "usage policy",
    "conditions",
    "website policies",
    "website policy",
)
CC_MARKER = "creativecommons"
CC_LABEL = "Creative Commons"
CC_API_CODE = "creativeCommon"
STANDARD_LABEL = "Standard Youtube"
DOCUMENT_SUFFIXES = (".pdf", ".epub", ".docx", ".doc")

VIDEO_URL_PREFIX = "https://www.youtube.com/watch?v="
SHORT_VIDEO_URL_PREFIX = "https://youtu.be/"
CHANNEL_URL_PREFIX = "https://www.youtube.com/channel/"
BLOCKED_CHANNELS = ("UCmyKnNRH0wH-r8I-ceP-dsg", "UCcTKQnC3lRA4aira95_a1pw")
API_PAGE_SIZE = 50

DOWNLOAD_ERRORS = (
    ": YouTube said: Unable to extract video data",
    "Did not get any data blocks",
    "HTTP Error 404: Not Found",
)
DOWNLOAD_ABORT = "HTTP Error 429"
MAX_STDERR_CHARS = 5

SCRAPED_SITE_PREFIX = "https://nroer.gov.in"

KANNADA_RANGE = ("ಀ", "೿")
TAMIL_RANGE = ("஀", "௿")

METADATA_COLUMNS = (
    "raw_file_name", "duration", "title", "speaker_name", "audio_id", "cleaned_duration",
    "num_of_speakers", "language", "has_other_audio_signature", "type", "source",
    "experiment_use", "utterances_files_list", "source_url", "speaker_gender",
    "source_website", "experiment_name", "mother_tongue", "age_group", "recorded_state",
    "recorded_district", "recorded_place", "recorded_date", "purpose", "license",
)

# ---------------------------------------------------------------------------
# Settings
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class CrawlConfig:
    """Settings of a web crawl (seed list or search-engine driven)."""

    language: str = "Kannada"
    language_code: str = "kn"
    keywords: tuple = ("songs download", "kavita download")
    word_to_ignore: tuple = WORDS_TO_IGNORE
    extensions_to_ignore: tuple = EXTENSIONS_TO_IGNORE
    extensions_to_include: tuple = MEDIA_EXTENSIONS
    pages: int = 10
    depth: int = 2
    continue_page: str = "NO"
    last_visited: int = 100
    enable_hours_restriction: str = "NO"
    max_hours: float = 1

    @property
    def hours_limited(self) -> bool:
        return self.enable_hours_restriction.lower() == "yes"

    @property
    def start_offset(self) -> int:
        return self.last_visited if self.continue_page.lower() == "yes" else 0


@dataclass(frozen=True)
class HarvestConfig:
    """Settings of a search-result harvest; an empty language code means English."""

    language: str = "gujarati"
    language_code: str = "gu"
    keywords: tuple = ()
    words_to_ignore: tuple = ()
    extensions_to_ignore: tuple = EXTENSIONS_TO_IGNORE
    max_pages: int = 50
    headless: bool = False

    @property
    def wiki_language(self) -> str:
        return self.language_code or "en"


@dataclass(frozen=True)
class ChannelSearchConfig:
    """Settings of a channel search through the listing API."""

    language: str = "Kannada"
    language_code: str = "kn"
    keywords: tuple = ("news", "speech", "talks", "poetry", "stories")
    words_to_ignore: tuple = (
        "song", "music", "tech", "physics", "maths", "lecture", "comedy", "tiktok",
        "funny", "jukebox",
    )
    max_results: int = 100

    @property
    def page_size(self) -> int:
        return min(self.max_results, API_PAGE_SIZE)

    @property
    def page_count(self) -> int:
        return max(1, -(-self.max_results // API_PAGE_SIZE))


@dataclass(frozen=True)
class ChannelPipelineConfig:
    """Settings of the channel download pipeline."""

    mode: str = "channel"
    only_creative_commons: bool = True
    source_name: str = "scraped_videos"
    batch_num: int = 5
    url_column: str = "video_url"
    speaker_column: str = "speaker_name"
    gender_column: str = "speaker_gender"
    license_column: str = "license"


@dataclass(frozen=True)
class MetadataConfig:
    """Config-side values of a media metadata row; ``None`` means unset."""

    mode: str | None = "complete"
    audio_id: str | None = None
    cleaned_duration: str | None = None
    num_of_speakers: str | None = None
    language: str | None = "Bodo"
    has_other_audio_signature: str | bool | None = "False"
    type: str | None = "audio"
    source: str | None = "DEMO"
    experiment_use: str | bool | None = "False"
    utterances_files_list: str | None = None
    source_website: str | None = ""
    experiment_name: str | None = None
    mother_tongue: str | None = None
    age_group: str | None = None
    recorded_state: str | None = None
    recorded_district: str | None = None
    recorded_place: str | None = None
    recorded_date: str | None = None
    purpose: str | None = None
    speaker_gender: str | None = None
    speaker_name: str | None = None

    def text(self, name: str) -> str | None:
        """The value as it appears in a metadata file."""
        value = getattr(self, name)
        return None if value is None else str(value)


PLAYLIST_METADATA = MetadataConfig(
    language="Tamil",
    source="CRAWL_SOURCE_TAMIL",
    source_website="https://www.youtube.com",
)


@dataclass(frozen=True)
class StorageConfig:
    """Bucket layout; ``channel_blob_path`` may hold a ``<language>`` placeholder."""

    channel_blob_path: str = "data/raw/<language>"
    archive_blob_path: str = "archive"
    channels_file_blob_path: str = "channels"
    scraped_data_blob_path: str = "data_to_be_scraped"
    archive_file_name: str = "archive.txt"
    token_file_name: str = "token.txt"
