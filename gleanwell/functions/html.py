"""Markup helpers: tags, attributes, anchors and visible text of a captured page.

Each helper walks the page text once with a regular expression whose repeats are
possessive, so that long pages neither backtrack nor deepen the stack.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanwell.functions import sqltext as sql
from gleanwell.functions.text import decode_entities_sql, strip_sql
from gleanwell.functions.urls import base_parts_sql, resolve_sql, resolve_url_sql

_ATTRS = r"""(?:[^>"\x27]++|"[^"]*"|\x27[^\x27]*\x27)*+"""
_COMMENT = r"!--.*?(?:-->|\z)"


def _raw_element(names: str, group: int) -> str:
    """An element whose content is not markup, up to its end tag or the end of the page."""
    return rf"({names})(?=[\s/>]).*?(?:</\{group}\s*>|\z)"


# The rest of a tag; one with unbalanced quotes ends at the next ">".
_REST = rf"(?:{_ATTRS}>|[^>]*+>)"
_REST_OR_CUT = rf"(?:{_ATTRS}>|[^>]*+(?:>|\z))"

_LINK_TAG = rf"(?is)<(?:{_COMMENT}|{_raw_element('script|style', 1)}|(?:a|source|audio|base)(?=[\s/>]){_REST})"
_ANCHOR = (
    rf"(?is)<(?:{_COMMENT}|{_raw_element('script|style', 1)}"
    rf"|a(?=[\s/>]){_REST}"
    rf"(?:[^<]++|<{_COMMENT}|<{_raw_element('script|style', 2)}|<(?!/?a(?=[\s/>])))*+)"
)
_TOKEN = rf"(?is)<(?:{_COMMENT}|{_raw_element('script|style', 1)}|/?[a-z]{_REST_OR_CUT})|[^<]++|<"
# A head ends at its end tag or before the body; one with neither holds what only a head can.
_HEAD = r"head(?=[\s/>]).*?(?:</head\s*>|(?=<body[\s/>]))"
_OPEN_HEAD = (
    rf"head(?=[\s/>]){_REST_OR_CUT}"
    rf"(?:\s++|<{_COMMENT}|<(title|script|style|noscript)(?=[\s/>]).*?(?:</\2\s*>|\z)|<(?:meta|link|base)(?=[\s/>]){_REST_OR_CUT})*+"
)
_NOT_TEXT = (
    rf"(?is)<(?:{_COMMENT}|{_raw_element('script|style|noscript', 1)}|{_HEAD}|{_OPEN_HEAD}"
    rf"|/body\s*>\s*(?:</html\s*>\s*)?\z|[/!?]?[a-z]{_REST_OR_CUT})"
)
_VOID = r"(?i)^<(?:area|base|br|col|embed|hr|img|input|link|meta|param|source|track|wbr)(?=[\s/>])"


def _attribute_pattern(name: str) -> str:
    value = r"""(?:"[^"]*"|\x27[^\x27]*\x27|[^\s>"\x27][^\s>]*+)"""
    return sql.lit(
        rf"(?is)^<[a-z]++(?:[\s/]*+(?!{name}[\s=>/])[^\s=>/]++(?:\s*+=\s*+{value})?+)*+"
        rf"[\s/]*+{name}(?=[\s=>/])(?:\s*+=\s*+({value}))?+"
    )


def _attributes(tags: str, name: str) -> str:
    """Raw values of attribute ``name`` over an array of start tags; tags without it are skipped."""
    return f"flatten(transform({tags}, t -> regexp_extract_all(t, {_attribute_pattern(name)}, 1)))"


def _value(raw: str) -> str:
    """An attribute value without its quotes, references decoded."""
    inner = f"CASE WHEN left({raw}, 1) IN ('\"', '\\u0027') THEN substring({raw}, 2, length({raw}) - 2) ELSE {raw} END"
    return decode_entities_sql(inner, lenient=False)


def _only(tags: str, tag: str) -> str:
    return rf"filter({tags}, t -> t RLIKE r'(?i)^<{tag}[\s/>]')"


def link_tags_sql(page: str) -> str:
    """Tags that carry links or the base address, in document order, outside scripts and comments."""
    return _only(f"regexp_extract_all({page}, {sql.lit(_LINK_TAG)}, 0)", "(?:a|source|audio|base)")


def links_sql(tags: str) -> str:
    """``a`` links, then ``source`` links, then ``audio`` links, as (tag, href); copies kept."""
    raw = ", ".join(
        f"transform({_attributes(_only(tags, tag), name)}, v -> named_struct('tag', '{tag}', 'raw', v))"
        for tag, name in (("a", "href"), ("source", "src"), ("audio", "src"))
    )
    return f"transform(concat({raw}), l -> named_struct('tag', l.tag, 'href', {_value('l.raw')}))"


def resolved_links_sql(links: str, base: str) -> str:
    """The links with their absolute ``url`` on a page whose base parts are ``base``."""
    url = resolve_sql(base, "l.href")
    return f"transform({links}, l -> named_struct('tag', l.tag, 'href', l.href, 'url', {url}))"


def anchor_hrefs_sql(tags: str) -> str:
    return f"transform({_attributes(_only(tags, 'a'), 'href')}, v -> {_value('v')})"


def base_href_sql(tags: str) -> str:
    """``href`` of the first ``<base>`` tag that has one, else NULL."""
    values = f"transform({_attributes(_only(tags, 'base'), 'href')}, v -> {strip_sql(_value('v'))})"
    return f"get(filter({values}, h -> h <> ''), 0)"


def document_base_sql(url: str, tags: str) -> str:
    """Base parts that relative links refer to: the page's, or those of its ``<base href>``."""
    address = f"CASE WHEN __href IS NULL THEN {url} ELSE {resolve_url_sql(url, '__href')} END"
    return base_parts_sql(sql.let(base_href_sql(tags), "__href", address))


def _direct_texts(content: str) -> str:
    """Text nodes of an element's content that lie in no nested element."""
    opens = rf"k RLIKE r'(?i)^<[a-z]' AND NOT k RLIKE {sql.lit(_VOID)} AND NOT k RLIKE r'(?i)^<(?:script|style)[\s/>]'"
    step = (
        f"CASE WHEN {opens} THEN named_struct('depth', acc.depth + 1, 'texts', acc.texts) "
        "WHEN k RLIKE r'(?i)^</[a-z]' THEN named_struct('depth', greatest(acc.depth - 1, 0), 'texts', acc.texts) "
        "WHEN acc.depth = 0 AND NOT k RLIKE r'(?i)^<[!a-z]' "
        "THEN named_struct('depth', acc.depth, 'texts', concat(acc.texts, array(k))) ELSE acc END"
    )
    nested = (
        f"aggregate(regexp_extract_all({content}, {sql.lit(_TOKEN)}, 0), "
        f"named_struct('depth', 0, 'texts', {sql.NO_TEXTS}), (acc, k) -> {step}, acc -> acc.texts)"
    )
    texts = f"CASE WHEN {content} = '' THEN {sql.NO_TEXTS} WHEN contains({content}, '<') THEN {nested} ELSE array({content}) END"
    return f"transform({texts}, n -> {decode_entities_sql('n', lenient=False)})"


def anchors_sql(page: str) -> str:
    """Array of (href, texts) over the page's ``<a href>`` elements, in document order."""
    elements = _only(f"regexp_extract_all({page}, {sql.lit(_ANCHOR)}, 0)", "a")
    open_tag = sql.lit(rf"(?is)^<a{_REST}")
    href = sql.let(f"get({_attributes('array(tag)', 'href')}, 0)", "v", _value("v"))
    texts = sql.let("substring(el, length(tag) + 1)", "c", _direct_texts("c"))
    one = sql.let(f"regexp_extract(el, {open_tag}, 0)", "tag", f"named_struct('href', {href}, 'texts', {texts})")
    return f"filter(transform({elements}, el -> {one}), a -> a.href IS NOT NULL)"


def visible_texts_sql(page: str) -> str:
    """Normalised text nodes of the body outside script, noscript and style.

    A node of white space only stays as an empty string. Character references are decoded
    twice: by the markup and once more on the text, as the data model asks.
    """
    nodes = f"filter(split({page}, {sql.lit(_NOT_TEXT)}, -1), n -> n <> '')"
    decoded = decode_entities_sql(decode_entities_sql("n", lenient=False), lenient=True)
    return f"transform({nodes}, n -> regexp_replace(replace({strip_sql(decoded)}, '\r\n', ''), ' {{2,}}', ' '))"


def link_tags(page: str) -> Column:
    return F.expr(link_tags_sql(page))


def links(page: str) -> Column:
    return F.expr(links_sql(link_tags_sql(page)))


def base_href(page: str) -> Column:
    return F.expr(base_href_sql(link_tags_sql(page)))


def anchors(page: str) -> Column:
    return F.expr(anchors_sql(page))


def visible_texts(page: str) -> Column:
    return F.expr(visible_texts_sql(page))
