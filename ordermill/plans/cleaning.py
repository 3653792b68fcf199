"""Raw tables to clean tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ordermill.functions.text import blank_to_null, text_to_bool, tidy_category, tidy_option_group
from ordermill.operators.dedupe import keep_one
from ordermill.operators.stages import Stage, apply_stages, stage_counts
from ordermill.schemas import ITEM_KEYS, OPTION_KEYS, stamped


@dataclass(frozen=True)
class ItemRules:
    """What counts as test data and as an outlier; limits are inclusive.

    Apps and locations that hold test orders are each company's own: none are excluded unless named.
    """

    excluded_apps: Sequence[str] = ()
    excluded_restaurants: Sequence[str] = ()
    # The category that holds test items, and the limits.
    excluded_categories: Sequence[str] = ("Test Items",)
    price_limits: tuple[Decimal, Decimal] = (Decimal("0"), Decimal("50"))
    quantity_limits: tuple[int, int] = (1, 20)


def _price(name: str) -> Column:
    return F.col(name).try_cast("decimal(10,2)")


def _quantity(name: str) -> Column:
    return F.col(name).try_cast("int")


def _amount(price: str, quantity: str) -> Column:
    return (F.col(price) * F.col(quantity)).cast("decimal(12,2)")


def _all_present(keys: Sequence[str]) -> Column:
    present = F.col(keys[0]).isNotNull()
    for key in keys[1:]:
        present = present & F.col(key).isNotNull()
    return present


def item_stages(rules: ItemRules = ItemRules()) -> list[Stage]:
    """Filters on raw line items.

    Where test apps or locations are named, a row without app or location is
    dropped, since nothing says it is no test order; a row without category
    stays and is named Unknown later.
    """
    def not_among(column: str, values: Sequence[str]) -> Column:
        return ~F.col(column).isin(*values) if values else F.lit(True)

    category = F.col("ITEM_CATEGORY")
    real_order = (
        not_among("APP_NAME", rules.excluded_apps)
        & not_among("RESTAURANT_ID", rules.excluded_restaurants)
        & (category.isNull() | ~category.isin(*rules.excluded_categories))
    )
    in_range = (
        _price("ITEM_PRICE").between(*map(F.lit, rules.price_limits))
        & _quantity("ITEM_QUANTITY").between(*rules.quantity_limits)
    )
    return [
        ("after_test_data", real_order),
        ("after_null_keys", _all_present(ITEM_KEYS)),
        ("after_outliers", in_range),
    ]


def clean_order_items(
    raw: DataFrame, rules: ItemRules = ItemRules(), run_ts: str | None = None, observation: Observation | None = None,
) -> DataFrame:
    """Typed line items without test data, outliers and repeated keys; extra columns pass through."""
    kept = apply_stages(raw, item_stages(rules), observation)
    typed = kept.withColumns({
        "CREATION_TIME_UTC": F.try_to_timestamp(F.col("CREATION_TIME_UTC")),
        "ITEM_PRICE": _price("ITEM_PRICE"),
        "ITEM_QUANTITY": _quantity("ITEM_QUANTITY"),
        "IS_LOYALTY": text_to_bool(F.col("IS_LOYALTY")),
        "ITEM_CATEGORY": tidy_category(F.col("ITEM_CATEGORY")),
    })
    # Derived after the dedupe: they depend on the row alone and need not be shuffled.
    derived = keep_one(typed, ITEM_KEYS).withColumns({
        "order_date": F.to_date("CREATION_TIME_UTC"),
        "order_hour": F.hour("CREATION_TIME_UTC"),
        "line_item_revenue": _amount("ITEM_PRICE", "ITEM_QUANTITY"),
        "is_anonymous": F.col("USER_ID").isNull(),
        "is_zero_price_flag": F.col("ITEM_PRICE") == 0,
    })
    return stamped(derived, "silver_ingestion_ts", run_ts)


def item_stage_counts(raw: DataFrame, rules: ItemRules = ItemRules()) -> DataFrame:
    return stage_counts(raw, item_stages(rules), [F.col(k) for k in ITEM_KEYS])


def option_stages() -> list[Stage]:
    in_range = (_price("OPTION_PRICE") >= 0) & (_quantity("OPTION_QUANTITY") >= 1)
    return [("after_null_keys", _all_present(OPTION_KEYS)), ("after_values", in_range)]


def clean_options(raw: DataFrame, run_ts: str | None = None, observation: Observation | None = None) -> DataFrame:
    """Typed options with unified group names; names that fall together are one row."""
    kept = apply_stages(raw, option_stages(), observation)
    typed = kept.withColumns({
        "OPTION_PRICE": _price("OPTION_PRICE"),
        "OPTION_QUANTITY": _quantity("OPTION_QUANTITY"),
        "OPTION_GROUP_NAME": tidy_option_group(F.col("OPTION_GROUP_NAME")),
        "OPTION_NAME": F.trim("OPTION_NAME"),
    })
    derived = keep_one(typed, OPTION_KEYS).withColumns({
        "is_paid_option": F.col("OPTION_PRICE") > 0,
        "option_revenue": _amount("OPTION_PRICE", "OPTION_QUANTITY"),
    })
    return stamped(derived, "silver_ingestion_ts", run_ts)


def option_stage_counts(raw: DataFrame) -> DataFrame:
    keys = [F.col("ORDER_ID"), F.col("LINEITEM_ID"),
            tidy_option_group(F.col("OPTION_GROUP_NAME")), F.trim("OPTION_NAME")]
    return stage_counts(raw, option_stages(), keys)


def _calendar_day() -> Column:
    return F.try_to_date(F.col("date_key"), "dd-MM-yyyy")


def calendar_stages() -> list[Stage]:
    return [("after_null_keys", F.col("date_key").isNotNull()), ("after_bad_dates", _calendar_day().isNotNull())]


def clean_calendar(raw: DataFrame, run_ts: str | None = None, observation: Observation | None = None) -> DataFrame:
    """Calendar with real dates; the text it came from stays in ``date_key_raw``."""
    kept = apply_stages(raw, calendar_stages(), observation)
    typed = kept.withColumns({
        "date_key_raw": F.col("date_key"),
        "date_key": _calendar_day(),
        **{c: F.col(c).try_cast("int") for c in ("year", "month", "week")},
        **{c: text_to_bool(F.col(c), wide=True) for c in ("is_weekend", "is_holiday")},
        "holiday_name": blank_to_null(F.col("holiday_name")),
    })
    return stamped(typed, "silver_ingestion_ts", run_ts)
