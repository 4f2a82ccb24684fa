"""URL and referrer expressions.

``parse_url`` raises on URLs browsers accept (``?q=a|b``) and ``str_to_map``
raises on repeated names, so hosts and parameters are taken with anchored
regular expressions.  Each expression mentions its input as few times as
possible: Catalyst copies whole expressions into pushed-down filters, and the
copies must stay small enough to compile.
"""

from __future__ import annotations

import re
from urllib.parse import quote

from pyspark.sql import Column
from pyspark.sql import functions as F

from clicktrail.functions.text import WHITESPACE, stripped
from clicktrail.rules import Rules

# optional scheme, '//', optional userinfo, host
_HOST = r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#]*@)?([^/?#:]+)"
_QUERY = r"^[^?#]*\?"
_VALUE = "([^&#]+)"


def url_host(url: Column) -> Column:
    """Lower-cased host without userinfo and port; '' when there is none."""
    return F.lower(F.regexp_extract(url, _HOST, 1))


def registrable_domain(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def _first_value_of(name: str) -> str:
    """Pattern from the start of the query to the first non-empty value of a
    parameter; once found, no later value of that name is tried."""
    return "(?>(?:[^#]*?&)??" + re.escape(name) + "=(?=[^&#]))"


def _not_blank() -> str:
    """Lookahead: the value is more than encoded or plain whitespace."""
    encoded = "|".join(f"(?i:{quote(c, safe='')})" for c in WHITESPACE)
    return rf"(?!(?:\+|{encoded}|[{re.escape(WHITESPACE)}])*(?:[&#]|\z))"


def raw_url_param(url: Column, *names: str, skip_blank: bool = False) -> Column:
    """Value of the first of ``names`` that has one, still encoded; '' if none.

    One regex: its alternatives are tried in the order of the names, each over
    the whole query.
    """
    test = _not_blank() if skip_blank else ""
    ordered = "|".join(_first_value_of(n) + test for n in names)
    return F.regexp_extract(url, f"{_QUERY}(?:{ordered}){_VALUE}", 1)


def url_decoded(value: Column) -> Column:
    """Form decoding that keeps malformed escapes as they are."""
    return F.url_decode(F.regexp_replace(value, "%(?![0-9A-Fa-f]{2})", "%25"))


def url_param(url: Column, *names: str) -> Column:
    """Decoded, trimmed parameter value; NULL when absent or empty."""
    return stripped(url_decoded(F.nullif(raw_url_param(url, *names), F.lit(""))))


def search_domain(referrer: Column) -> Column:
    return registrable_domain(url_host(referrer))


def search_touch(referrer: Column, rules: Rules, blank_keyword: str = "keep") -> Column:
    """``struct<domain, keyword>`` for a referrer that is a search result page, else NULL.

    A value that is blank only after decoding (``q=%20``) is an empty keyword
    under ``keep``; under ``skip`` the next parameter is tried instead.
    """
    if blank_keyword not in ("keep", "skip"):
        raise ValueError(f"blank_keyword must be 'keep' or 'skip', not {blank_keyword!r}")
    domain = search_domain(referrer)
    raw = raw_url_param(referrer, *rules.keyword_params, skip_blank=blank_keyword == "skip")
    keyword = stripped(url_decoded(raw))
    if rules.keyword_normalize_case:
        keyword = F.lower(keyword)
    # Cheap tests first: most referrers are internal links and stop at the '?' or the host.
    is_search = F.contains(referrer, F.lit("?")) & domain.isin(*rules.search_engine_domains) & (raw != "")
    return F.when(is_search, F.struct(domain.alias("domain"), keyword.alias("keyword")))
