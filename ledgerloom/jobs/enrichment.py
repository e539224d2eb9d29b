"""Monthly contract enrichment: lookups, canonical names, bands, payments and implied rates.

The booking month is filtered first, so every later join works on one month. No step
counts or shows its result: the whole job is one plan, run once by the caller's write.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import bands, finance
from ledgerloom.functions.scalars import months_since_model_year
from ledgerloom.operators.joins import lookup_by_either, lookup_equi


@dataclass
class EnrichmentTables:
    """Inputs by role; the columns each must have are listed in the README."""

    contracts: DataFrame
    residual_terms: DataFrame
    applications: DataFrame
    loyalty: DataFrame
    make_alias: DataFrame
    model_alias: DataFrame
    delinquency: DataFrame
    collateral: DataFrame


@dataclass
class EnrichmentRules:
    """What differs between portfolios."""

    make_groups: Mapping[int, str] = field(default_factory=dict)
    other_makes: str = "othermake"
    model_rules: Sequence[tuple[int, str, str, str]] = ()


def booked_in_month(contracts: DataFrame, as_of: date) -> DataFrame:
    """Contracts booked from the first of the month up to ``as_of``."""
    return contracts.filter(F.col("booking_date").between(F.lit(as_of.replace(day=1)), F.lit(as_of)))


def with_names(df: DataFrame, tables: EnrichmentTables, rules: EnrichmentRules) -> DataFrame:
    """Clean model text, find the make by either spelling, correct the model name."""
    df = df.withColumns(
        {
            "model": bands.prefix_rules(F.col("vehicle_code"), rules.model_rules, F.col("model")),
            # Demonstrators count as used.
            "new_used": F.when(F.col("new_used") == "d", "u").otherwise(F.col("new_used")),
        }
    )
    df = lookup_by_either(df, tables.make_alias, "make_code", "make", "misspelled", "make_id", "make_id")
    df = lookup_equi(df, tables.model_alias, {"make_id": "make_id", "model": "misspelled"}, {"correct": "canonical_model"})
    group = bands.code_map(F.col("make_id"), rules.make_groups, rules.other_makes) if rules.make_groups else F.lit(rules.other_makes)
    return df.withColumn("make_group", group)


def with_bands(df: DataFrame) -> DataFrame:
    """Subsidy flag, term band, score grade, state, vehicle age class."""
    age = months_since_model_year(F.col("booking_date"), F.col("model_year"))
    return df.withColumns(
        {
            "subsidised": F.when(F.col("subsidy") > 0, 1).otherwise(0),
            "term_band": bands.band(F.col("term_months"), bands.TERM_BANDS, bands.TERM_DEFAULT),
            "grade": bands.band(F.col("score"), bands.SCORE_GRADES, bands.SCORE_DEFAULT),
            "state": bands.code_map(F.col("state_code"), bands.STATE_CODES, bands.STATE_DEFAULT),
            "age_class": bands.band(age, bands.AGE_CLASSES, bands.AGE_DEFAULT),
        }
    )


def with_collateral(df: DataFrame) -> DataFrame:
    """Collateral value by fallback, and the booked loan-to-value percent."""
    df = df.withColumn("invoice_amount", F.coalesce("invoice_amount", F.lit(0.0)))
    price = F.when(F.col("invoice_amount") > 0, F.col("invoice_amount")).otherwise(F.col("adjusted_price"))
    value = bands.first_positive([price, F.col("alternate_invoice"), F.col("wholesale_amount")], 1.0)
    return df.withColumn("booked_ltv", bands.loan_to_value(F.col("capital_cost"), value))


def with_rates(df: DataFrame) -> DataFrame:
    """Four payments and the yearly rates they imply (repaying the cost down to the residual)."""
    df = finance.payment_columns(
        df, "capital_cost", "residual", "term_months", "buy_rate", "money_factor", "markup_rate", "subsidised"
    )
    # Payments fall due at the start of a period.
    yearly = lambda payment: 12 * finance.implied_rate(
        F.col("term_months"), F.col(payment), -F.col("capital_cost"), -F.col("residual"), F.lit(1)
    )
    return df.withColumns(
        {
            "rate_buy": yearly("pmt_buy_rate"),
            "rate_customer": yearly("pmt_customer"),
            "rate_programme": yearly("pmt_programme"),
            "rate_standard_programme": yearly("pmt_standard_programme"),
        }
    )


def enrich(tables: EnrichmentTables, rules: EnrichmentRules, as_of: date, txn_id: int) -> DataFrame:
    df = booked_in_month(tables.contracts, as_of)
    terms = tables.residual_terms.withColumn("period", F.col("period").cast("int"))
    df = lookup_equi(
        df.withColumn("period", F.col("period").cast("int")), terms, {"account_no": "account_no", "period": "period"},
        {"base_pct": "residual_base_pct", "base_amount": "residual_base_amount", "subsidy_amount": "residual_subsidy"},
    )
    df = lookup_equi(
        df, tables.applications, {"application_id": "application_id"},
        {"invoice_amount": "invoice_amount", "wholesale_amount": "wholesale_amount", "alternate_invoice": "alternate_invoice",
         "loan_to_income": "loan_to_income"},
    )
    df = lookup_equi(df, tables.loyalty, {"application_id": "application_id"}, {"flag": "loyalty"}).fillna("n", ["loyalty"])
    df = with_bands(with_names(df, tables, rules))
    df = lookup_equi(
        df, tables.delinquency, {"make_group": "make_group", "term_band": "term", "grade": "grade"}, {"rate": "delinquency_rate"}
    )
    df = lookup_equi(df, tables.collateral, {"manufacturer_id": "manufacturer_id"}, {"rate": "collateral_rate"})
    df = with_rates(with_collateral(df))
    return df.withColumns(
        {
            "run_period": F.lit(as_of.year * 100 + as_of.month),
            "rebate": F.lit(0),
            "txn_id": F.lit(txn_id).cast("bigint"),
            "start_at": F.lit(as_of),
            "end_at": F.lit(as_of),
        }
    )
