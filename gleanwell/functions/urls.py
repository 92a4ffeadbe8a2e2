"""URL helpers: resolution, domains, file names, channel and video addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanwell.config import CHANNEL_URL_PREFIX, SHORT_VIDEO_URL_PREFIX, VIDEO_URL_PREFIX
from gleanwell.functions import sqltext as sql
from gleanwell.functions.text import as_column

# scheme, authority, path, query, fragment (RFC 3986, appendix B)
_URL = sql.lit(r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$")
_LEADING_JUNK = sql.chars("".join(map(chr, range(0x21))))

# Root-relative reference with no query, fragment, dot segment or empty segment.
_SIMPLE_ROOT_REF = sql.lit(r"^(?:/[^/.?#\x00-\x20][^/?#\x00-\x20]*+)++/?$")


def _parts(url: str) -> str:
    names = ("scheme", "host", "path", "query", "fragment")
    fields = ", ".join(f"'{n}', regexp_extract(u, {_URL}, {i})" for i, n in enumerate(names, start=1))
    return sql.let(url, "u", f"named_struct('url', u, {fields})")


def base_parts_sql(url: str) -> str:
    folder = "coalesce(nullif(regexp_replace(r.path, '[^/]*$', ''), ''), '/')"
    return sql.let(
        _parts(url),
        "r",
        "named_struct('url', r.url, 'scheme', lower(r.scheme), 'host', r.host, 'path', r.path, "
        f"'folder', {folder}, 'query', r.query)",
    )


def _without_dot_segments(path: str, keep_empty: str) -> str:
    """Collapse ``.`` and ``..``, and empty inner segments unless kept, of a path from the root."""
    inner = f"filter(slice(s, 2, greatest(size(s) - 2, 0)), x -> {keep_empty} OR x <> '')"
    walked = (
        f"aggregate(concat({inner}, array(element_at(s, -1))), {sql.NO_TEXTS}, (done, x) -> "
        "CASE x WHEN '..' THEN slice(done, 1, greatest(size(done) - 1, 0)) WHEN '.' THEN done "
        "ELSE concat(done, array(x)) END)"
    )
    end = f"CASE WHEN element_at(s, -1) IN ('.', '..') THEN array('') ELSE {sql.NO_TEXTS} END"
    return sql.let(f"split({path}, '/', -1)", "s", f"concat('/', array_join(concat({walked}, {end}), '/'))")


def _tail(mark: str, part: str) -> str:
    return f"CASE WHEN {part} = '' THEN '' ELSE concat('{mark}', {part}) END"


def resolve_sql(base: str, ref: str) -> str:
    """Absolute form of ``ref`` on a page whose :func:`base_parts` are ``base``.

    Plain root-relative links take a short path; everything else goes through the full
    rule: other schemes stay as they are, ``//host`` keeps the page's scheme, query-only and
    fragment-only references keep the path, dot segments are collapsed.
    """
    clean = f"ltrim({_LEADING_JUNK}, translate({ref}, '\t\r\n', ''))"
    rooted = "startswith(r.path, '/')"
    tidy = sql.let(
        f"CASE WHEN {rooted} THEN r.path ELSE concat({base}.folder, r.path) END",
        "full",
        rf"CASE WHEN full RLIKE r'//|/\.' THEN {_without_dot_segments('full', rooted)} ELSE full END",
    )
    path = f"CASE WHEN r.host <> '' THEN r.path WHEN r.path = '' THEN {base}.path ELSE {tidy} END"
    query = f"CASE WHEN r.host = '' AND r.path = '' AND r.query = '' THEN {base}.query ELSE r.query END"
    whole = (
        f"concat({base}.scheme, '://', CASE WHEN r.host <> '' THEN r.host ELSE {base}.host END, {path}, "
        + sql.let(query, "q", _tail("?", "q"))
        + f", {_tail('#', 'r.fragment')})"
    )
    full_rule = sql.let(
        _parts(clean),
        "r",
        f"CASE WHEN r.scheme <> '' AND lower(r.scheme) <> {base}.scheme THEN {ref} ELSE {whole} END",
    )
    return (
        f"CASE WHEN {ref} RLIKE {_SIMPLE_ROOT_REF} THEN concat({base}.scheme, '://', {base}.host, {ref}) "
        f"WHEN {ref} = '' THEN {base}.url ELSE {full_rule} END"
    )


def base_parts(url: str) -> Column:
    """Split a page address once, so that all its links can be resolved against the parts."""
    return F.expr(base_parts_sql(url))


def resolve_url_sql(base_url: str, ref: str) -> str:
    bound = sql.let(ref, "__ref", resolve_sql("__base", "__ref"))
    return sql.let(base_parts_sql(base_url), "__base", bound)


def resolve_url(base_url: str, ref: str) -> Column:
    return F.expr(resolve_url_sql(base_url, ref))


def request_key(url: Column | str) -> Column:
    """What tells requests apart: the address without its fragment, with its arguments in order.

    An argument without a value counts as one with an empty value; empty arguments and an empty list of them count
    for nothing.
    """
    asked = F.substring_index(as_column(url), "#", 1)
    path = F.substring_index(asked, "?", 1)
    given = F.filter(F.split(F.substr(asked, F.length(path) + 2), "&"), lambda x: x != "")
    named = F.transform(given, lambda x: F.when(F.contains(x, F.lit("=")), x).otherwise(F.concat(x, F.lit("="))))
    return F.when(F.size(named) > 0, F.concat(path, F.lit("?"), F.array_join(F.array_sort(named), "&"))).otherwise(path)


def source_domain(url: Column | str) -> Column:
    """Host part, without ``www.`` if it begins with it; NULL for an address without ``//``."""
    u = as_column(url)
    host = F.substring_index(F.substr(u, F.instr(u, F.lit("//")) + 2), "/", 1)
    bare = F.when(F.startswith(host, F.lit("www.")), F.replace(host, F.lit("www."), F.lit(""))).otherwise(host)
    return F.when(F.contains(u, F.lit("//")), bare)


def url_title(url: Column | str) -> Column:
    return F.substring_index(as_column(url), "/", -1)


def safe_file_name(url: Column | str) -> Column:
    return F.translate(url_title(url), "%,", "__")


def file_format(name: Column | str) -> Column:
    return F.substring_index(as_column(name), ".", -1)


def meta_file_name(name: Column | str) -> Column:
    """Name of the metadata file; every occurrence of the format is replaced."""
    n = as_column(name)
    return F.replace(n, file_format(n), F.lit("csv"))


def channel_url(channel_id: Column | str) -> Column:
    return F.concat(F.lit(CHANNEL_URL_PREFIX), as_column(channel_id))


def channel_id(url: Column | str) -> Column:
    return F.substring_index(as_column(url), "/", -1)


def clean_channel_title(title: Column | str) -> Column:
    # Characters beyond the replacement string are deleted, hence the quote comes last.
    return F.translate(as_column(title), " ,/\\.$'", "______")


def clean_channel_name(name: Column | str) -> Column:
    return F.translate(as_column(name), " ", "_")


def channel_file_key(cid: Column | str, name: Column | str) -> Column:
    return F.concat(as_column(cid), F.lit("__"), as_column(name))


def split_channel_file(key: Column | str, file_mode: bool = False) -> tuple[Column, Column]:
    """``<id>__<name>.txt`` to (channel_id, channel_name); in file mode the id is unknown."""
    k = as_column(key)
    cid = F.substring_index(k, "__", 1)
    name = F.replace(F.replace(k, F.concat(cid, F.lit("__")), F.lit("")), F.lit(".txt"), F.lit(""))
    return (F.lit(None).cast("string") if file_mode else cid), name


def video_url(video_id: Column | str) -> Column:
    return F.concat(F.lit(VIDEO_URL_PREFIX), as_column(video_id))


def video_id_from_url(url: Column | str) -> Column:
    without_long = F.replace(as_column(url), F.lit(VIDEO_URL_PREFIX), F.lit(""))
    return F.replace(without_long, F.lit(SHORT_VIDEO_URL_PREFIX), F.lit(""))


def absolute_link(prefix: str, path: Column | str) -> Column:
    return F.concat(F.lit(prefix), as_column(path))
