"""Contract profitability: dated lookups, run-off cost of funds, loss adjustors, marginal costs.

A chain of left lookups on small tables, each of which keeps one row per contract, around
one run-off calculation. Lookups that the job needs twice are made once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import bands, finance
from ledgerloom.functions.scalars import months_since_model_year, year_month
from ledgerloom.operators.joins import lookup_equi
from ledgerloom.operators.lookups import Override, band_join, metric_lookup, override_lookups
from ledgerloom.operators.sweep import FEW, Dated, sweep
from ledgerloom.session import tidy_shuffles, written_table

EQUITY_COST = 0.1  # fixed value: cost of equity
EARNING_RATE = 0.0435  # fixed value: earning rate on subsidised contracts
START_WACC = 0.03  # fixed value: capital cost of the first run-off pass
COLLECTION_FEE = 25 * 0.6334  # fixed value
GAP_EXPENSE = 0.0002  # fixed value
CPR_SPEED = 0.015  # fixed value


@dataclass
class ProfitTables:
    """Inputs by role; every dated table has ``beg`` and ``end``. See the README for columns."""

    contracts: DataFrame
    stage: DataFrame
    drivers: DataFrame
    metrics: DataFrame
    dealers: DataFrame
    capital: DataFrame
    returns: DataFrame
    curve_types: DataFrame
    curves: DataFrame
    liquidity_curves: DataFrame
    management_fees: DataFrame
    credit_adjustments: DataFrame
    overrides: DataFrame
    dealer_adjustors: DataFrame
    loyalty_adjustors: DataFrame
    portfolio_adjustors: DataFrame
    expenses: DataFrame
    losses: DataFrame
    relationships: DataFrame
    marginal_rates: DataFrame


@dataclass
class ProfitRules:
    region_codes: Mapping[str, str] = field(default_factory=dict)
    expense_columns: Sequence[str] = ("sales", "credit", "imaging", "servicing", "collections", "overhead")
    relationship_columns: Sequence[str] = ()
    line: str = "lease"


def with_bands(df: DataFrame) -> DataFrame:
    """Terms, speeds, ages and periods by fixed bands."""
    return df.withColumns(
        {
            "drive_date": F.coalesce("lease_date", "booking_date"),
            "tax_rate": bands.band_by_date(F.col("booking_date"), bands.TAX_RATES, bands.TAX_DEFAULT),
            "speed": bands.band(F.col("term_months"), bands.PREPAY_SPEEDS, bands.PREPAY_DEFAULT),
            "term_band": bands.band(F.col("term_months"), bands.TERM_BANDS, bands.TERM_DEFAULT),
            "age_class": bands.band(
                months_since_model_year(F.col("booking_date"), F.col("model_year")), bands.AGE_CLASSES, bands.AGE_DEFAULT
            ),
            "booked_period": year_month(F.col("booking_date")),
            "lease_period": year_month(F.col("lease_date")),
        }
    )


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


def _dealer_lookups(t: ProfitTables) -> list[Dated]:
    """What the run-off needs of the contract's own keys."""
    dealer = {"manufacturer_id": "manufacturer_id", "manufacturer": "business_line"}
    return [
        Dated(t.dealers, {"dealer_location": "dealer_location"}, "booking_date", dealer),
        Dated(t.liquidity_curves, {}, "lease_date", {"name": "lease_liquidity"}),
        Dated(t.liquidity_curves, {}, "booking_date", {"name": "booked_liquidity"}),
    ]


def _curve_type(t: ProfitTables) -> Dated:
    on = {"subsidised": "subsidised", "manufacturer_id": "manufacturer_id"}
    return Dated(t.curve_types, on, "booking_date", _same("curve_type"))


def with_dimensions(df: DataFrame, t: ProfitTables, rules: ProfitRules) -> DataFrame:
    """Stage flags, bands, market metrics, and all dated lookups: one sweep for all whose keys are known, then the next."""
    # Rows are shuffled by account before anything is added to them.
    df = lookup_equi(df, t.stage, {"account_no": "account_no"}, {"new_used_flag": "new_used_flag", "grade": "stage_grade"})
    df = with_bands(df.withColumn("line", F.lit(rules.line)))
    df = df.withColumn("region", bands.code_map(F.col("dealer_location"), rules.region_codes) if rules.region_codes else F.lit(None).cast("string"))
    df = metric_lookup(df, t.metrics, {"booking_date": "as_of"}, "label", "value", {"1m": "index_1m", "24m": "index_24m"})
    driver = lambda key, out: Dated(t.drivers, {}, "lease_date", {"measure": out}, constants={"line": rules.line, "dim_key": key})
    capital = {"model": "model", "make_id": "make_id"}
    df = sweep(df, [
        *_dealer_lookups(t), driver("debt", "senior_debt"), driver("capital_charge", "capital_charge"),
        Dated(t.capital, capital, "booking_date", _same("capital", "capital_market", "capital_standard")),
    ])
    maker = {"manufacturer_id": "manufacturer_id"}
    columns = rules.expense_columns
    fees = _same("origination_fee", "revenue_share", "subvention_fund")
    df = sweep(df, [
        _curve_type(t), Dated(t.management_fees, {**maker, "subsidised": "subsidised", "age_class": "age_class"}, "booking_date", fees),
        Dated(t.returns, {**maker, "model": "model", "term_band": "term", "stage_grade": "grade"}, "drive_date", _same("return_rate")),
        Dated(t.expenses, maker, "lease_date", {c: f"{c}_expense" for c in columns}),
        Dated(t.marginal_rates, maker, "lease_date", {f"{c}_rate": f"{c}_marginal_rate" for c in columns}),
    ])
    line = {"business_line": "business_line", "curve_type": "curve_type"}
    df = sweep(df, [Dated(t.credit_adjustments, line, "booking_date", _same("credit_adjustment"))])
    # Written here: the run-off, adjustors and expenses are then planned on a table and not on all these joins once more.
    return written_table(df.withColumn("subordinated_debt", F.col("senior_debt")), "dimensions", codec="zstd")


def _curve_names(df: DataFrame) -> DataFrame:
    name = lambda when: F.concat_ws("|", F.date_format(when, "yyyy-MM-dd"), F.col("curve_type"))
    return df.withColumns({"lease_curve": name("lease_date"), "booked_curve": name("booking_date")})


def _moments(t: ProfitTables) -> tuple[DataFrame, DataFrame]:
    """Curves reduced to the moments of the banded terms, written once: every pass reads these two small tables."""
    terms = [label for _, _, label in bands.TERM_BANDS] + [bands.TERM_DEFAULT]
    reduced = lambda curves: finance.by_curve(finance.curve_moments(curves, "name", "curve", max(terms), terms=terms))
    written = written_table(reduced(t.curves), "curves"), written_table(reduced(t.liquidity_curves), "liquidity")
    # A curve has a few hundred bytes; few of them are sent to the tasks, so contracts are not shuffled by their names.
    return tuple(F.broadcast(c) if c.count() <= FEW else c for c in written)


_COMMON = ("capital_cost", "residual", "term_band", "speed", "wacc")


def _booked_run_off(df: DataFrame, funds: DataFrame, liquidity: DataFrame) -> DataFrame:
    """Rates on the booking-date curves and the balances."""
    return finance.run_off(
        df, {"booked_cof": funds, "booked_lp": liquidity, "booked_cf": funds},
        {"booked_cof": "booked_curve", "booked_lp": "booked_liquidity", "booked_cf": "curve_type"}, *_COMMON,
    )


def with_run_off(df: DataFrame, t: ProfitTables) -> DataFrame:
    """Costs of funds on the lease-date and booking-date curves, capital cost, discounted balances."""
    funds, liquidity = _moments(t)
    df = finance.run_off(
        _curve_names(df).withColumn("wacc", F.lit(START_WACC)), {"cof": funds, "lp": liquidity, "cf": funds},
        {"cof": "lease_curve", "lp": "lease_liquidity", "cf": "curve_type"}, *_COMMON, balances=None,
    )
    wacc = finance.cost_of_capital(F.col("cof"), F.col("tax_rate"), F.col("markup_amount"), F.lit(EQUITY_COST))
    # The balances depend on the capital cost just found, the booked rates do not: one pass gives both.
    return _booked_run_off(df.withColumn("wacc", wacc), funds, liquidity)


def with_fees(df: DataFrame) -> DataFrame:
    """Amounts spread over the balances."""
    anr, disc = F.col("anr"), F.col("anr_disc")
    return df.withColumns(
        {
            "subsidy_revenue": finance.gross_up(F.col("subsidy"), anr, disc),
            "acquisition_fee": finance.gross_up(F.col("markup_amount"), anr, disc),
            "dealer_premium": finance.gross_up(F.col("dealer_upfront"), anr, disc),
            "subsidy_buydown": F.when(F.col("subsidy") > 0, (F.col("buy_rate") - EARNING_RATE) * anr).otherwise(0.0),
            "reserve_benefit": F.col("residual") * F.col("index_24m"),
        }
    )


def with_adjustors(df: DataFrame, t: ProfitTables, occurring: DataFrame | None = None) -> DataFrame:
    """Keys replaced by their overrides, then dealer, loyalty and portfolio loss adjustors.

    Keys that the contracts do not carry have the fixed values of the report: any manufacturer and channel, all dealer
    groups, franchise dealers, no certification, an income ratio of 0. ``occurring`` is a stored table with the lines and
    booked periods of the contracts.
    """
    df = df.fillna(0, ["score", "credit_score"]).withColumns(
        {
            "any_manufacturer": F.lit(-1),
            "any_channel": F.lit(-1),
            "dealer_group": F.lit("all"),
            "dealer_type": F.lit("franchise"),
            "certified": F.lit("x"),
            "graded": F.lit("y"),
            "income_ratio": F.lit(0),
            "loyal": F.when(F.col("loyalty") == "y", 1).otherwise(0),
            "new_used_class": F.when(F.col("age_class") == "new", "new").otherwise("used"),
        }
    )
    df = override_lookups(df, t.overrides, [
        Override("dealer", "manufacturer", "any_manufacturer", "dealer_manufacturer"),
        Override("dealer", "make", "make_id", "dealer_make"),
        Override("dealer", "channel", "any_channel", "dealer_channel"),
        Override("loyalty", "manufacturer", "manufacturer_id", "loyalty_manufacturer"),
        Override("loyalty", "make", "make_id", "loyalty_make"),
        Override("loyalty", "loyal", "loyal", "loyalty_flag"),
        Override("loyalty", "subsidised", "subsidised", "loyalty_subsidised"),
        Override("loyalty", "new_used", "new_used_class", "loyalty_new_used"),
        Override("loyalty", "age", "age_class", "loyalty_age"),
        Override("portfolio", "manufacturer", "manufacturer_id", "portfolio_manufacturer"),
        Override("portfolio", "income_ratio", "income_ratio", "portfolio_income_ratio"),
        Override("portfolio", "make", "make_id", "portfolio_make"),
        Override("portfolio", "subsidised", "subsidised", "portfolio_subsidised"),
    ], "booked_period", "line", occurring)
    df = band_join(
        df, t.dealer_adjustors,
        {"dealer_make": "make_id", "dealer_manufacturer": "manufacturer_id", "dealer_channel": "channel_id",
         "dealer_group": "dealer_group", "dealer_type": "dealer_type"},
        [("booked_period", "beg", "end")], {"adjustor": "dealer_adjustor"},
    )
    df = band_join(
        df, t.loyalty_adjustors,
        {"loyalty_make": "make_id", "loyalty_manufacturer": "manufacturer_id", "loyalty_flag": "loyal", "loyalty_subsidised": "subsidised",
         "loyalty_new_used": "new_used", "loyalty_age": "age", "graded": "graded"},
        [("lease_period", "beg", "end"), ("score", "min_score", "max_score"), ("credit_score", "min_credit", "max_credit")],
        {"adjustor": "loyalty_adjustor"},
    )
    df = band_join(
        df, t.portfolio_adjustors,
        {"portfolio_make": "make_id", "portfolio_manufacturer": "manufacturer_id", "portfolio_subsidised": "subsidised",
         "certified": "certified", "graded": "graded"},
        [("lease_period", "beg", "end"), ("portfolio_income_ratio", "min_income_ratio", "max_income_ratio"), ("term_band", "min_term", "max_term"), ("booked_ltv", "min_ltv", "max_ltv"),
         ("score", "min_score", "max_score"), ("credit_score", "min_credit", "max_credit")],
        {"adjustor": "portfolio_adjustor"},
    )
    return df.withColumns(
        {name: F.lit(1.0) for name in ("dynamic_adjustor", "macro_adjustor", "first_credit_adjustor", "second_credit_adjustor")}
    )


def with_expenses(df: DataFrame, t: ProfitTables, rules: ProfitRules) -> DataFrame:
    """Losses, customer relationship, marginal costs."""
    columns = rules.expense_columns
    df = lookup_equi(
        df, t.losses, {"make_id": "make_id", "term_band": "term", "stage_grade": "grade"}, {"net_loss": "net_loss"}
    )
    if rules.relationship_columns:
        df = lookup_equi(
            df, t.relationships, {"application_id": "application_id"}, {c: c for c in rules.relationship_columns}
        )
    return finance.marginal_costs(df, [(f"{c}_expense", f"{c}_marginal_rate", f"{c}_marginal") for c in columns])


def with_weights(df: DataFrame) -> DataFrame:
    """Amounts weighted by the average balance, and the fixed columns of the report."""
    anr = F.col("anr")
    return df.withColumns(
        {
            "funding_expense": F.try_divide(F.col("residual_subsidy"), anr),
            "depreciation_expense": F.when(F.col("residual_subsidy") != 0, F.col("residual")),
            "purchase_fee": 1 - F.col("return_rate"),
            "preferred_dividend_weight": F.col("capital") * anr,
            "loss_reserve_weight": F.col("net_loss") * anr,
            "dealer_markup_weight": F.col("rate_programme") * anr,
            "cross_funding_weight": F.col("cf") * anr,
            "recapture_weight": F.lit(0.0),
            "net_dealer_premium": F.col("dealer_premium"),
            "collection_fee": F.lit(COLLECTION_FEE),
            "gap_expense": F.lit(GAP_EXPENSE),
            "cpr_speed": F.lit(CPR_SPEED),
            "earning_rate": F.lit(EARNING_RATE),
            "equity_cost": F.lit(EQUITY_COST),
        }
    )


def profitability(tables: ProfitTables, rules: ProfitRules) -> DataFrame:
    """All contracts with their profit measures."""
    base = tables.contracts.toDF(*[c.lower() for c in tables.contracts.columns])
    with tidy_shuffles(base.sparkSession):
        dimensions = with_dimensions(base, tables, rules)
        df = with_fees(with_run_off(dimensions, tables))
        df = with_adjustors(df, tables, dimensions)
        return with_weights(with_expenses(df, tables, rules))


def balances(tables: ProfitTables) -> DataFrame:
    """Booking period, business line and average balance ``anr`` of all contracts: of the job only what these need."""
    base = tables.contracts.toDF(*[c.lower() for c in tables.contracts.columns])
    with tidy_shuffles(base.sparkSession):
        df = sweep(with_bands(base), _dealer_lookups(tables))
        df = _curve_names(sweep(df, [_curve_type(tables)])).withColumn("wacc", F.lit(START_WACC))
        return _booked_run_off(df, *_moments(tables)).select("booked_period", "business_line", "anr")


def period_totals(profit: DataFrame) -> DataFrame:
    """Contracts and balance per booking period and business line, for merging into a load log.

    ``profit`` is what :func:`profitability` gives, or :func:`balances` where the totals are all that is wanted.
    """
    return profit.groupBy(F.col("booked_period").alias("period"), "business_line").agg(
        F.count(F.lit(1)).alias("n_contracts"), F.sum("anr").alias("anr")
    )
