"""Business rules and data contracts.

Every operator takes a :class:`Rules` value instead of reading settings from
the environment.  Field names are the setting names users already keep in
their JSON rule files, so :meth:`Rules.from_json` needs no translation table.
"""

from __future__ import annotations

import dataclasses
import json
from dataclasses import dataclass

# --- fixed values: the input contract -------------------------------------
HIT_COLUMNS = (
    "hit_time_gmt",
    "date_time",
    "user_agent",
    "ip",
    "event_list",
    "geo_city",
    "geo_region",
    "geo_country",
    "pagename",
    "page_url",
    "product_list",
    "referrer",
)
SEARCH_DOMAINS = ("google.com", "yahoo.com", "bing.com", "ask.com", "aol.com", "msn.com")
KEYWORD_PARAMS = ("q", "p", "query", "text", "s", "qs")
PRODUCT_FIELDS = ("category", "name", "quantity", "revenue", "events", "evars")
REPORT_COLUMNS = ("Search Engine Domain", "Search Keyword", "Revenue")
SEM_COLUMNS = (
    "search_engine_domain",
    "search_keyword",
    "total_clicks",
    "unique_sessions",
    "converting_sessions",
    "total_revenue",
    "conversion_rate",
    "revenue_per_click",
    "avg_order_value",
    "run_date",
    "run_id",
)
REPORT_FILENAME = "{date}_SearchKeywordPerformance.tab"
# Type names used in rule files, as Spark types; text is always valid text.
TYPE_NAMES = {"int": "bigint", "float": "double", "datetime": "timestamp_ntz"}
MODELS = ("first_touch", "last_touch", "linear", "time_decay")
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class Rules:
    # The defaults of all settings are part of the contract.
    required_columns: tuple[str, ...] = HIT_COLUMNS
    critical_columns: tuple[str, ...] = ("hit_time_gmt", "ip", "referrer")
    dedup_key_columns: tuple[str, ...] = ("hit_time_gmt", "ip", "page_url")
    pii_columns: tuple[str, ...] = ("ip", "user_agent")
    column_dtypes: tuple[tuple[str, str], ...] = (
        ("hit_time_gmt", "int"),
        ("date_time", "datetime"),
        ("ip", "string"),
        ("referrer", "string"),
        ("event_list", "string"),
        ("product_list", "string"),
    )

    search_engine_domains: tuple[str, ...] = SEARCH_DOMAINS
    keyword_params: tuple[str, ...] = KEYWORD_PARAMS
    purchase_event_id: str = "1"
    revenue_col_index: int = 3
    product_delimiter: str = ","
    product_attr_delimiter: str = ";"
    event_delimiter: str = ","
    keyword_normalize_case: bool = True
    min_revenue_threshold: float = 0.0
    session_key_column: str = "ip"

    attribution_model: str = "first_touch"
    half_life_seconds: int = 7 * 86400
    require_prior_touch: bool = False

    null_warning_threshold_pct: float = 50
    fail_on_schema_error: bool = True
    fail_on_null_critical: bool = True
    reject_type_errors: bool = False
    enforce_filename_date: bool = True
    strip_crlf: bool = True

    output_columns: tuple[str, ...] = REPORT_COLUMNS
    revenue_decimal_places: int = 2
    sort_ascending: bool = False
    filename_pattern: str = REPORT_FILENAME
    output_delimiter: str = "\t"
    output_encoding: str = "UTF-8"
    file_encoding: str = "UTF-8"

    def __post_init__(self):
        if self.attribution_model not in MODELS:
            raise ValueError(f"unknown attribution model {self.attribution_model!r}")
        if self.half_life_seconds < 120:
            raise ValueError("half_life_seconds must be at least 120")
        if len(self.output_columns) != 3:
            raise ValueError("output_columns needs a domain, a keyword and a revenue name")

    @classmethod
    def from_json(cls, text: str | None) -> "Rules":
        """Defaults overridden by the keys of a JSON object."""
        given = json.loads(text) if text else {}
        known = {f.name for f in dataclasses.fields(cls)}
        unknown = sorted(set(given) - known)
        if unknown:
            raise ValueError(f"unknown rule settings: {unknown}")
        if "column_dtypes" in given:
            given["column_dtypes"] = tuple(given["column_dtypes"].items())
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in given.items()})

    def but(self, **changes) -> "Rules":
        return dataclasses.replace(self, **changes)
