"""Event lists, product lists and money."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from clicktrail.functions.text import WHITESPACE, literal_pattern
from clicktrail.rules import PRODUCT_FIELDS, Rules

AMOUNT = "decimal(20,6)"
TOTAL = "decimal(38,6)"


def has_event(event_list: Column, event_id: str, delimiter: str = ",") -> Column:
    """Whether an ID is an element of a delimited list; blanks around it are ignored.

    One regex search instead of split + transform keeps the test code-generated.
    """
    blank = "[" + re.escape(WHITESPACE) + "]*"
    edge = literal_pattern(delimiter)
    pattern = f"(?:^|{edge}){blank}{literal_pattern(event_id)}{blank}(?:{edge}|\\z)"
    return F.coalesce(F.contains(event_list, F.lit(event_id)) & event_list.rlike(pattern), F.lit(False))


def has_purchase(event_list: Column, rules: Rules) -> Column:
    return has_event(event_list, rules.purchase_event_id, rules.event_delimiter)


def amount(text: Column) -> Column:
    """Text to money; anything that is not a plain number is NULL."""
    return text.try_cast(AMOUNT)


def products(product_list: Column, rules: Rules) -> Column:
    """Product entries of a product list as an array of text."""
    return F.split(product_list, literal_pattern(rules.product_delimiter), -1)


def product_field(product: Column, index: int, rules: Rules) -> Column:
    """Attribute ``index`` (from 0) of one product; '' when the entry is short."""
    return F.split_part(product, F.lit(rules.product_attr_delimiter), F.lit(index + 1))


def product_revenue(product_list: Column, rules: Rules) -> Column:
    """Summed revenue of all products; missing or malformed amounts count as 0."""
    zero = F.lit(0).cast(TOTAL)

    def price(product: Column) -> Column:
        fields = F.split(product, literal_pattern(rules.product_attr_delimiter), -1)
        return F.coalesce(amount(F.get(fields, F.lit(rules.revenue_col_index))), F.lit(0))

    summed = F.aggregate(products(product_list, rules), zero, lambda total, p: (total + price(p)).cast(TOTAL))
    return F.coalesce(summed, zero)


def product_struct(product: Column, rules: Rules) -> Column:
    return F.struct(
        *[product_field(product, i, rules).alias(name) for i, name in enumerate(PRODUCT_FIELDS)]
    )


def revenue_text(value: Column, places: int = 2) -> Column:
    """Fixed-point text without thousands separators."""
    return value.cast(f"decimal(38,{places})").cast("string")


def ratio(numerator: Column, denominator: Column, places: int = 2) -> Column:
    """Rounded quotient, 0 when there is nothing to divide by."""
    return F.when(denominator > 0, F.round(numerator / denominator, places)).otherwise(F.lit(0))


def epoch_seconds(text: Column) -> Column:
    return text.try_cast("bigint")
