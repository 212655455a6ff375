"""The model's inputs, declared once: which column each is and how it comes from the panel.

``INPUTS`` maps every input to the rule that derives it, or to None where the
panel brings it. Rules on history get the one window of a store's weeks, so a
plan has a single Exchange + Sort + Window whatever the number of rules (no
Exchange on a panel bucketed by store). Lags are row shifts: equal to week
lags on a gap-free panel (use ``densify_panel`` first when a panel has holes).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tillpanel.functions.metrics import log_target


@dataclass(frozen=True)
class Rule:
    """How an input is derived: ``make`` gets the window of the store's weeks; ``history`` if it looks back."""

    make: Callable[[WindowSpec], Column]
    history: bool = False


def weeks_ago(k: int) -> Rule:
    return Rule(lambda weeks: F.lag("sales", k).over(weeks), history=True)


def mean_before(k: int) -> Rule:
    """Mean of the k weeks before (null without a value); an exact DECIMAL sum, so free of summation order."""
    def make(weeks: WindowSpec) -> Column:
        before = weeks.rowsBetween(-k, -1)
        known = F.count("sales").over(before)
        return F.when(known > 0, F.sum(F.col("sales").cast("decimal(38,8)")).over(before).cast("double") / known)
    return Rule(make, history=True)


def spread_before(k: int) -> Rule:
    """Sample deviation of the k weeks before; null with less than two values."""
    return Rule(lambda weeks: F.stddev_samp("sales").over(weeks.rowsBetween(-k, -1)), history=True)


def of_date(part: Callable[[str], Column]) -> Rule:
    return Rule(lambda _: part("date"))


# The model's inputs, in the model's order. The ISO week goes with the calendar year.
INPUTS: dict[str, Rule | None] = {
    "store_nbr": None, "holiday_flag": None, "temperature": None, "fuel_price": None, "cpi": None, "unemployment": None,
    "month": of_date(F.month), "week_of_year": of_date(F.weekofyear), "year": of_date(F.year),
    "sales_lag_1": weeks_ago(1), "sales_lag_4": weeks_ago(4), "sales_lag_52": weeks_ago(52),
    "sales_roll_mean_4": mean_before(4), "sales_roll_mean_8": mean_before(8), "sales_roll_std_4": spread_before(4),
}
STORE = "store_nbr"
LOG_SALES = "log_sales"


def numeric_inputs() -> list[str]:
    return [name for name in INPUTS if name != STORE]


def history_inputs() -> list[str]:
    return [name for name, rule in INPUTS.items() if rule and rule.history]


def with_inputs(panel: DataFrame, log_sales: bool = True) -> DataFrame:
    """The panel with every derived input and, if wanted, the training target: one form for training and scoring."""
    weeks = Window.partitionBy(STORE).orderBy("date")
    derived = {name: rule.make(weeks) for name, rule in INPUTS.items() if rule}
    return panel.withColumns(derived | ({LOG_SALES: log_target(F.col("sales"))} if log_sales else {}))


def model_inputs(df: DataFrame) -> DataFrame:
    """The inputs that ``df`` has, in the model's order."""
    have = set(df.columns)
    return df.select([name for name in INPUTS if name in have])


def with_last_week(df: DataFrame) -> DataFrame:
    """Rows whose last week is known: the pairs that a persistence forecast can be judged on."""
    return df.filter(F.col("sales_lag_1").isNotNull())
