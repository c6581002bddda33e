"""URL rules. All are regular expressions, not ``parse_url``, which yields NULL on odd characters."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

_SCHEME = r"^([a-zA-Z][a-zA-Z0-9+.\-]*):"
_NETLOC = r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)"
_CONTROL_OR_SPACE = "".join(map(chr, range(0x21)))


def _tidy(u: Column) -> Column:
    return F.translate(F.ltrim(u, F.lit(_CONTROL_OR_SPACE)), "\t\r\n", "")


def scheme(u: Column) -> Column:
    return F.lower(F.regexp_extract(_tidy(u), _SCHEME, 1))


def netloc(u: Column) -> Column:
    return F.regexp_extract(_tidy(u), _NETLOC, 1)


def host(u: Column) -> Column:
    """Network location without user info and port, lower case."""
    return F.lower(F.regexp_replace(netloc(u), r"^.*@|:[0-9]*$", ""))


def base_url(u: Column) -> Column:
    """``scheme://netloc/``; NULL gives ``''``."""
    return F.coalesce(F.concat(scheme(u), F.lit("://"), netloc(u), F.lit("/")), F.lit(""))


def url_last_segment(u: Column, cut_query: bool = True) -> Column:
    last = F.substring_index(u, "/", -1)
    return F.substring_index(last, "?", 1) if cut_query else last


def after_token(href: Column, token: str) -> Column:
    """Text after the last ``token``; NULL when the token is absent."""
    return F.when(F.contains(href, F.lit(token)), F.substring_index(href, token, -1))


def strip_last_path(u: Column) -> Column:
    return F.regexp_replace(u, r"/[^/]*\z", "")


def canonical_url(u: Column) -> Column:
    """Without query and fragment."""
    return F.regexp_extract(u, r"^[^?#]*", 0)


def query_param(u: Column, name: str) -> Column:
    """First ``name=`` value anywhere in the URL, ``''`` when there is none."""
    return F.regexp_extract(u, f"{name}=([^&]+)", 1)


def next_page_url(u: Column, page: Column) -> Column:
    """The URL with its ``page`` parameter set to ``page + 1``."""
    following = F.concat(F.lit("page="), (page + 1).cast("string"))
    head = F.substring_index(u, "#", 1)
    fragment = F.regexp_extract(u, r"#.*", 0)
    glue = F.when(F.contains(head, F.lit("?")), F.lit("&")).otherwise(F.lit("?"))
    replaced = F.regexp_replace(
        head, F.lit(r"([?&])page=[^&]*"), F.concat(F.lit("$1"), following))
    return F.concat(
        F.when(F.rlike(head, F.lit(r"[?&]page=")), replaced)
        .otherwise(F.concat(head, glue, following)),
        fragment,
    )


def make_absolute(href: Column, base: Column) -> Column:
    """Absolute form of a link, NULL for blanks, fragments and non-HTTP schemes."""
    h = strip(href)
    return (
        F.when((h == "") | F.startswith(h, F.lit("#")), F.lit(None).cast("string"))
        .when(F.startswith(h, F.lit("//")), F.concat(scheme(base), F.lit(":"), h))
        .when(F.startswith(h, F.lit("/")),
              F.concat(scheme(base), F.lit("://"), netloc(base), h))
        .when(F.startswith(h, F.lit("http")), h)
    )


def remove_dot_segments(path: Column) -> Column:
    """Resolves ``.`` and ``..`` in an absolute path."""
    segments = F.split(path, "/")
    folded = F.aggregate(
        F.slice(segments, F.lit(2), F.greatest(F.size(segments) - 1, F.lit(0))),
        F.array().cast("array<string>"),
        lambda done, s: F.when(s == "..", F.slice(done, F.lit(1),
                                                  F.greatest(F.size(done) - 1, F.lit(0))))
        .when(s == ".", done)
        .otherwise(F.array_append(done, s)),
    )
    trailing = F.when(F.rlike(path, F.lit(r"/\.{1,2}\z")) & (F.size(folded) > 0), F.lit("/")
                      ).otherwise(F.lit(""))
    return F.concat(F.lit("/"), F.array_join(folded, "/"), trailing)


def url_join(base: Column, href: Column) -> Column:
    """Resolves a link against the page it stands on (RFC 3986)."""
    authority = F.concat(scheme(base), F.lit("://"), netloc(base))
    base_path = F.regexp_extract(base, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    folder = F.regexp_extract(base_path, r"^(.*/)[^/]*\z", 1)
    path = canonical_url(href)
    tail = F.regexp_extract(href, r"[?#].*", 0)
    beside = F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), path)
    absolute_path = F.when(F.startswith(path, F.lit("/")), path).otherwise(
        F.regexp_replace(beside, "/{2,}", "/"))
    resolved = F.when(F.rlike(absolute_path, F.lit(r"/\.{1,2}(?:/|\z)")),
                      remove_dot_segments(absolute_path)).otherwise(absolute_path)
    return (
        F.when(href == "", base)
        .when(F.rlike(href, F.lit(_SCHEME)), href)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme(base), F.lit(":"), href))
        .when(F.startswith(href, F.lit("?")), F.concat(canonical_url(base), href))
        .when(F.startswith(href, F.lit("#")), F.concat(F.substring_index(base, "#", 1), href))
        .otherwise(F.concat(authority, resolved, tail))
    )


def in_domain(u: Column, domain: str | Column) -> Column:
    """True when the host is the domain or one of its sub-domains."""
    d = F.lit(domain) if isinstance(domain, str) else domain
    h = host(u)
    return (h == d) | F.endswith(h, F.concat(F.lit("."), d))


# Substrings of links that are never followed.
IGNORED_LINK_PARTS = [
    "/account", "/cart", "/checkout", "/login", "javascript:", "tel:", "mailto:",
    "question", "review",
]


def is_ignored_link(href: Column) -> Column:
    return F.rlike(F.lower(href), F.lit("|".join(IGNORED_LINK_PARTS)))


def is_product_href(href: Column) -> Column:
    return F.contains(href, F.lit("/product/"))


def is_same_category_href(href: Column, page_url: Column) -> Column:
    """Pagination links that carry the category of the page they stand on."""
    category = query_param(page_url, "category")
    return (category != "") & F.contains(href, F.concat(F.lit("?category="), category))
