"""Rule-based classification, key normalisation and the dashboard keep rule
(PRJ-16, PRJ-17, FLT-05, FLT-06)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.config import Rule, account_rules


def _rule_condition(rule: Rule, header: Column, sub: Column, item: Column, entity: Column) -> Column:
    cond = header == F.lit(rule.header)
    if rule.sub is not None:
        cond = cond & (sub == F.lit(rule.sub))
    if rule.items is not None:
        cond = cond & item.isin(*rule.items)
    if rule.entity is not None:
        cond = cond & (entity == F.lit(rule.entity))
    return cond


def rule_index(rules: Sequence[Rule], header="header_code", sub="sub_header_code",
               item="item_code", entity="empresa") -> Column:
    """1-based index of the first matching rule (NULL: no rule matches). A
    NULL condition counts as not met."""
    h, s, i = F.col(header), F.col(sub), F.col(item)
    e = F.col(entity) if entity else F.lit(None).cast("string")
    idx = None
    for n, rule in enumerate(rules, start=1):
        cond = _rule_condition(rule, h, s, i, e)
        idx = F.when(cond, F.lit(n)) if idx is None else idx.when(cond, F.lit(n))
    return idx


def classify(df: DataFrame, rules: Sequence[Rule] | None = None, header="header_code",
             sub="sub_header_code", item="item_code", entity="empresa",
             drop_unmatched: bool = True) -> DataFrame:
    """Add ``fill_col`` and ``facet_col``; rows no rule matches are dropped.

    The rules are evaluated once into a rule index; fill and facet are array
    lookups on it, so the predicate pushed below the projection stays small.
    """
    rules = tuple(rules or account_rules())
    idx = F.col("__rule")
    fills = F.array(*[F.lit(r.fill) for r in rules])
    facets = F.array(*[F.lit(r.facet) for r in rules])
    out = df.withColumn("__rule", rule_index(rules, header, sub, item, entity))
    if drop_unmatched:
        out = out.where(idx.isNotNull())
    return out.withColumn("fill_col", F.when(idx.isNotNull(), F.element_at(fills, idx))) \
        .withColumn("facet_col", F.when(idx.isNotNull(), F.element_at(facets, idx))).drop("__rule")


def needs_zero_codes(header="header_code", sub="sub_header_code", item="item_code") -> Column:
    """Rows whose (sub, item) codes normalise to (0, 0): result rows (H),
    A/F totals with NULL sub and item, and F rows with item 0."""
    h, s, i = F.col(header), F.col(sub), F.col(item)
    is_h = h == F.lit("H")
    is_af_total = h.isin("A", "F") & s.isNull() & i.isNull()
    is_f_zero = (h == F.lit("F")) & (i == F.lit(0))
    return F.coalesce(is_h, F.lit(False)) | F.coalesce(is_af_total, F.lit(False)) | \
        F.coalesce(is_f_zero, F.lit(False))


def normalize_code_keys(df: DataFrame, header="header_code", sub="sub_header_code",
                        item="item_code") -> DataFrame:
    """Rewrite total/result rows to codes (0, 0); no-op if a code column is missing."""
    if not all(c in df.columns for c in (header, sub, item)):
        return df
    needs = needs_zero_codes(header, sub, item)
    types = dict(df.dtypes)
    # both codes are rewritten from the ORIGINAL values (simultaneous update)
    return df.withColumns({
        sub: F.when(needs, F.lit(0).cast(types[sub])).otherwise(F.col(sub)),
        item: F.when(needs, F.lit(0).cast(types[item])).otherwise(F.col(item)),
    })


def keep_flag(stock_entity: str = "ANCAP", header="header_code", sub="sub_header_code",
              item="item_code", entity="empresa") -> Column:
    """Leaf/total keep rule per header (FLT-05); NULL when a condition is NULL."""
    h, s, i, e = F.col(header), F.col(sub), F.col(item), F.col(entity)
    a_rule = ((s == 1) & (i == 0)) | ((s == 2) & (i == 0))
    b_rule = ((s == 1) & (i == 0)) | ((s == 2) & (i != 0)) | ((s == 3) & (i == 0))
    f_rule = ((e == F.lit(stock_entity)) & (s != 0)) | ((e != F.lit(stock_entity)) & (s == 0))
    return F.when(h == "A", a_rule).when(h == "B", b_rule).when(h == "F", f_rule).otherwise(F.lit(True))


def dashboard_facts(df: DataFrame, stock_entity: str = "ANCAP", threshold: float = 1.0,
                    result_facet: str = "Resultado") -> DataFrame:
    """Keep rule, result label override and magnitude threshold (CP-16).
    The ``keep`` column stays in the output."""
    facet = F.col("facet_col")
    label = F.when(facet.isNull(), F.lit(None).cast("string")) \
        .when(facet == F.lit(result_facet), F.lit(result_facet)).otherwise(F.col("label"))
    return df.withColumn("keep", keep_flag(stock_entity)) \
        .withColumn("label", label) \
        .where(F.col("keep")) \
        .where(F.abs(F.col("valor")) > F.lit(threshold))
