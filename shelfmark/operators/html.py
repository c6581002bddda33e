"""Reading HTML with built-in regular expressions, in layers.

A profile first cuts blocks out of a page, then reads raw strings from page and blocks, always
as arrays; ``clean`` decodes and strips all of them in one expression; only then come the
rules. Column expressions are trees, so each layer is a column of its own: a layer is
computed once per page, however many fields read it, and the plan stays small.

Repetitions are character classes or possessive groups, which the JVM runs in a loop, and a tag
never reaches over the next ``<``: a hostile page of any length can neither overflow the stack
nor backtrack without end.
"""

import json
import re
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import strip

# An unclosed one runs to the end of the page.
_NOISE = (r"(?is)<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)"
          r"|<!--.*?(?:-->|\z)")
_TAGS = r"<[^<>]*>"
_LEAF = r"<([a-zA-Z][a-zA-Z0-9]*+)\b[^<>]*+>[^<]*+</\1\s*+>"
# Leaf children in front of an element's own text, then that text.
_OWN_TEXT = rf"(?:{_LEAF})*+([^<]*+)"
_VALUE = r"\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"
_QUOTES = "\"'"

# Character references by name, from the standard library's table, as browsers know them; a hard
# space reads as a blank.
NAMED_REFERENCES = {name.rstrip(";"): text.replace("\xa0", " ") for name, text in html5.items()}
# The old names, which need no semicolon, longest first.
_OLD = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))
# What browsers read the numbers 128 to 159 as.
_WINDOWS = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0))
# The most usual references.
_USUAL = {"&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&nbsp;": " ", "&#39;": "'", "&#039;": "'"}

# A reference, a run of other text, or a stray ampersand.
_PIECE = r"(&(?:#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[a-zA-Z][a-zA-Z0-9]*+;?)|[^&]++|&)"
# In an attribute's value, an old name that goes on: part of a query, not a reference.
_QUERY_PART = rf"&(?=(?:{_OLD})[=0-9A-Za-z])(?![0-9A-Za-z]++;)"
# A quoted attribute value that holds a bracket.
_BRACKET_IN_VALUE = r"=\s*+(?:\"[^\"<>]*+[<>]|'[^'<>]*+[<>])"
# A tag (a run of plain text and whole quoted values), text, or a stray bracket.
_MARKUP = (r"<[a-zA-Z/](?:[^<>\"'=]++|=\s*+\"[^\"]*+\"(?=[\s/>])|=\s*+'[^']*+'(?=[\s/>])|[=\"'])*+>"
           r"|[^<]++|<")

# Elements that always have a closing tag and give a page its structure.
STRUCTURE = ["div", "section", "article", "header", "footer", "main", "nav", "aside",
             "form", "ul", "ol", "table", "figure"]


# ── patterns ─────────────────────────────────────────────────────────────────


def tag(name: str, cls: str | None = None, read: str | None = None, **attrs: str) -> str:
    """Pattern of an opening tag; ``*`` as name is any element.

    ``cls`` is one class among several. Other attributes compare by value; a value may
    start with ``*`` for "contains". Use ``class_`` for the whole class attribute and
    ``__`` for a hyphen in an attribute name. ``read`` captures an attribute's value.
    """
    looks = ""
    if cls:
        looks += (rf"(?=[^<>]*\s(?i:class)\s*=\s*[\"'](?:[^\"'<>]*\s)?{re.escape(cls)}"
                  r"(?:\s[^\"'<>]*)?[\"'])")
    for key, value in attrs.items():
        attr = re.escape(key.rstrip("_").replace("__", "-"))
        if value.startswith("*"):
            body = rf"[\"'][^\"'<>]*{re.escape(value[1:])}"
        else:
            body = rf"[\"']?{re.escape(value)}(?:[\"'\s>])"
        looks += rf"(?=[^<>]*\s(?i:{attr})\s*=\s*{body})"
    element = "[a-zA-Z][a-zA-Z0-9-]*+" if name == "*" else f"(?i:{name})"
    start = rf"<{element}(?=[\s>/]){looks}"
    return rf"{start}[^<>]*?\s(?i:{re.escape(read)}){_VALUE}[^<>]*+>" if read else rf"{start}[^<>]*+>"


def _content(name: str) -> str:
    """Everything up to the next closing tag of an element."""
    return rf"((?:[^<]++|<(?!/(?i:{name})[\s>]))*+)"


# ── the page ─────────────────────────────────────────────────────────────────


def strip_noise(html: Column) -> Column:
    """Without scripts, styles and comments, whose text could look like markup, and with the
    brackets in attribute values written as references."""
    return _let(without_scripts(html), plain_values)


def without_scripts(html: Column) -> Column:
    return F.regexp_replace(html, _NOISE, "")


def plain_values(page: Column) -> Column:
    """The page with the brackets in quoted attribute values as references. Few pages have any;
    the others are left as they are."""
    def in_tag(piece: Column) -> Column:
        inside = F.substring(piece, F.lit(2), F.length(piece) - 2)
        for bracket, ref in (("<", "&lt;"), (">", "&gt;")):
            inside = F.replace(inside, F.lit(bracket), F.lit(ref))
        return F.concat(F.lit("<"), inside, F.lit(">"))

    pieces = F.regexp_extract_all(page, F.lit(_MARKUP), F.lit(0))
    rewritten = F.array_join(F.transform(pieces, lambda p: F.when(
        F.startswith(p, F.lit("<")) & (p != "<"), in_tag(p)).otherwise(p)), "")
    return F.when(F.rlike(page, F.lit(_BRACKET_IN_VALUE)), rewritten).otherwise(page)


def has(html: Column, pattern: str) -> Column:
    return F.rlike(html, F.lit(pattern))


def count(html: Column, pattern: str) -> Column:
    return F.regexp_count(html, F.lit(pattern))


# ── fragments: strings of HTML ───────────────────────────────────────────────


def following(html: Column, pattern: str) -> Column:
    """Everything after the first match, ``''`` without one; NULL of a NULL."""
    parts = F.split(html, pattern, 2)
    return F.when(html.isNotNull(), F.coalesce(F.get(parts, F.lit(1)), F.lit("")))


def flats(html: Column, pattern: str, name: str, whole: bool = False) -> Column:
    """Contents of all matches, for elements that do not hold one of their own name; ``whole``
    keeps their opening tags in front."""
    return F.regexp_extract_all(html, F.lit(pattern + _content(name)), F.lit(0 if whole else 1))


def flat(html: Column, pattern: str, name: str) -> Column:
    return F.regexp_extract(html, pattern + _content(name), 1)


def flat_all(html: Column, pattern: str, name: str) -> Column:
    """``flats`` as one fragment."""
    return F.array_join(flats(html, pattern, name), "<br>")


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def inner_of_rest(rest: Column, name: str = "div") -> Column:
    """Inner HTML of an element, given everything that follows its opening tag.

    Cuts the text before each opening or closing tag of that name and walks the nesting
    depth, so elements of the same name inside it are kept. An unclosed element runs to the
    end of the page.
    """
    def step(at: Column, piece: Column) -> Column:
        closes = F.startswith(piece, F.lit("</"))
        opens = F.startswith(piece, F.lit("<")) & ~closes
        depth = at["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        kept = at["kept"] + F.when(depth > 0, 1).otherwise(0)
        return F.when(at["depth"] == 0, at).otherwise(
            F.struct(depth.alias("depth"), kept.alias("kept")))

    # The first piece is the text in front of any such tag; the space keeps it from being
    # taken for one.
    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("kept"))
    pieces = F.split(F.concat(F.lit(" "), rest), rf"(?=</?(?i:{name})[\s>/])")
    return _let(pieces, lambda p: F.array_join(
        F.slice(p, F.lit(1), F.aggregate(p, start, step)["kept"]), ""))


def inner(html: Column, pattern: str, name: str = "div") -> Column:
    """Inner HTML of the first match of an element, up to its own closing tag."""
    return inner_of_rest(following(html, pattern), name)


def piece_at(html: Column, path: list[tuple[str, int]]) -> Column:
    """The text from an element's opening tag to the next structural tag.

    ``path`` lists (element, position among its siblings of that name) from the fragment
    down. Only structural elements count for nesting, so unclosed inline tags do no harm.
    """
    names = F.array(*[F.lit(name) for name, _ in path])
    places = F.array(*[F.lit(k) for _, k in path])
    any_tag = "|".join(STRUCTURE)

    def step(at: Column, piece: Column) -> Column:
        closes = F.startswith(piece, F.lit("</"))
        opens = F.startswith(piece, F.lit("<")) & ~closes
        name = F.lower(F.regexp_extract(piece, "^<([a-zA-Z]+)", 1))
        wanted = opens & (at["depth"] == at["matched"]) & (name == F.get(names, at["matched"]))
        hit = wanted & (at["seen"] + 1 == F.get(places, at["matched"]))
        left = closes & (at["depth"] - 1 < at["matched"])
        # Nothing changes any more once the element is found, or a matched one left: its
        # position occurs once.
        return F.when((at["found"] > 0) | (at["matched"] < 0), at).otherwise(F.struct(
            (at["i"] + 1).alias("i"),
            (at["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)).alias("depth"),
            F.when(hit, at["matched"] + 1).when(left, -9).otherwise(at["matched"]).alias("matched"),
            F.when(hit, 0).when(wanted, at["seen"] + 1).otherwise(at["seen"]).alias("seen"),
            F.when(hit & (at["matched"] + 1 == len(path)), at["i"]).otherwise(at["found"]
                                                                            ).alias("found")))

    start = F.struct(F.lit(1).alias("i"), *[F.lit(0).alias(n)
                                            for n in ("depth", "matched", "seen", "found")])
    pieces = F.split(F.concat(F.lit(" "), html), rf"(?=</?(?i:{any_tag})[\s>/])")
    return _let(pieces, lambda p: F.coalesce(
        F.try_element_at(p, F.nullif(F.aggregate(p, start, step)["found"], F.lit(0))), F.lit("")))


# ── readings: arrays of raw strings ──────────────────────────────────────────


def text(html: Column, pattern: str) -> Column:
    """Own text of the first match."""
    return F.array(F.regexp_extract(html, pattern + _OWN_TEXT, 2))


def texts(html: Column, pattern: str) -> Column:
    """Own texts of all matches, in page order."""
    return F.regexp_extract_all(html, F.lit(pattern + _OWN_TEXT), F.lit(2))


def shown(html: Column, pattern: str, name: str) -> Column:
    """Text of the first match with that of its children, for elements that do not hold one of
    their own name."""
    return plain(flat(html, pattern, name))


def _unquoted(value: Column) -> Column:
    value = F.btrim(value, F.lit(_QUOTES))
    return F.when(F.contains(value, F.lit("&")), F.regexp_replace(value, _QUERY_PART, "&amp;")).otherwise(value)


def attr(html: Column, pattern: str) -> Column:
    """First value the pattern reads."""
    return F.array(_unquoted(F.regexp_extract(html, pattern, 1)))


def attrs(html: Column, pattern: str) -> Column:
    """All values the pattern reads, in page order."""
    return F.transform(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)), _unquoted)


def tags(html: Column, pattern: str) -> Column:
    """The opening tags themselves."""
    return F.regexp_extract_all(html, F.lit(pattern), F.lit(0))


def attr_of(tag_text: Column, name: str) -> Column:
    """Attribute of one tag, ``''`` if absent. A string, not a reading."""
    return _unquoted(F.regexp_extract(tag_text, rf"\s(?i:{re.escape(name)}){_VALUE}", 1))


def nodes(fragment: Column) -> Column:
    """All text nodes."""
    return F.split(fragment, _TAGS)


def own_nodes(fragment: Column) -> Column:
    """Text nodes outside child elements."""
    return F.split(F.regexp_replace(fragment, _LEAF, "<br>"), _TAGS)


def plain(fragment: Column) -> Column:
    """Text without tags."""
    return F.array(F.regexp_replace(fragment, _TAGS, ""))


# ── cleaning ─────────────────────────────────────────────────────────────────


def _by_number(body: Column) -> Column:
    """The character of a reference by number; those of Windows and impossible ones as in browsers."""
    digits = F.regexp_extract(body, "^#[xX]?0*([0-9a-fA-F]*)", 1)
    is_hex = F.rlike(body, F.lit("^#[xX]"))
    beyond = F.lit(0x110000).cast("bigint")
    code = F.coalesce(
        F.when(is_hex, F.when(F.length(digits) <= 6, F.conv(digits, 16, 10).cast("bigint")))
        .otherwise(F.when(F.length(digits) <= 7, F.conv(digits, 10, 10).cast("bigint"))), beyond)
    return (F.when(code.between(0x80, 0x9F), F.substring(F.lit(_WINDOWS), (code - 0x7F).cast("int"), F.lit(1)))
            .when(code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF),
                  F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
            .otherwise(F.lit("\ufffd")))


@lru_cache(maxsize=1)
def _names_by_letter() -> str:
    """The names as JSON: an object for each first letter from A to z, so that a search is short."""
    places: list[dict[str, str]] = [{} for _ in range(ord("A"), ord("z") + 1)]
    for name, text in NAMED_REFERENCES.items():
        places[ord(name[0]) - ord("A")][name] = text
    return json.dumps(places)


def _by_name(name: Column) -> Column:
    """The text a name stands for, NULL if it is none."""
    tables = F.from_json(F.lit(_names_by_letter()), "array<map<string,string>>")
    return F.try_element_at(F.get(tables, F.ascii(name) - ord("A")), name)


def _character(ref: Column) -> Column:
    """What a reference stands for; the reference itself if it stands for nothing.

    A name without a semicolon counts as far as it is one of the old names."""
    body = F.substring(ref, 2, 2147483647)
    old = F.regexp_extract(body, f"^(?:{_OLD})", 0)
    rest = F.substring(body, F.length(old) + 1, F.length(body))
    named = F.coalesce(
        F.when(F.endswith(body, F.lit(";")), _by_name(F.rtrim(body, F.lit(";")))),
        F.when(old != "", F.concat(_by_name(old), rest)), ref)
    found = F.when(F.startswith(body, F.lit("#")), _by_number(body)).otherwise(named)
    usual = F
    for name, text in _USUAL.items():
        usual = usual.when(ref == name, text)
    return usual.otherwise(found)


def unescape(c: Column) -> Column:
    """Decodes character references, each once."""
    pieces = F.regexp_extract_all(c, F.lit(_PIECE), F.lit(1))
    decoded = F.transform(pieces, lambda p: F.when(
        F.startswith(p, F.lit("&")) & (p != "&"), _character(p)).otherwise(p))
    return F.when(F.contains(c, F.lit("&")), F.array_join(decoded, "")).otherwise(c)


def clean(readings: Column) -> Column:
    """Decodes and strips every string of an array."""
    return F.transform(readings, lambda s: strip(unescape(s)))


# ── what rules need ──────────────────────────────────────────────────────────


def nth(values: Column, k: int) -> Column:
    """Entry ``k`` (1-based, negative from the end), ``''`` when there is none."""
    return F.coalesce(F.try_element_at(values, F.lit(k)), F.lit(""))


def joined(values: Column, sep: str = "") -> Column:
    """Non-blank entries joined."""
    return F.array_join(F.filter(values, lambda v: v != ""), sep)


def one_line(c: Column) -> Column:
    """Runs of white space as one space, as a browser shows them."""
    return F.regexp_replace(c, r"\s+", " ")
