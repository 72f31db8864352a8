"""Data-quality operators D1-D11.

Every check returns the DataFrame of failing rows; a check passes when it is
empty.  ``run_suite`` runs the checks as concurrent Spark jobs and returns
the summary, optionally storing each failing set (D10); ``suite_frame`` is
the same summary as one lazy union; ``assert_suite`` raises after the whole
suite has run (D11).

Null rules (our contract): ``not_null`` fails on nulls; ``unique``,
``accepted_values``, ``relationships``, ``accepted_range`` and
``expression_is_true`` let nulls pass.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from aulastar.config import DOMAIN, StarConfig
from aulastar.functions import matches_place


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def not_null_predicate(col: str) -> Column:
    return F.col(col).isNull()


def accepted_values_predicate(col: str, values: Sequence) -> Column:
    return ~F.col(col).isin(list(values))


def expression_predicate(expression: str | Column, where: str | Column | None = None) -> Column:
    e = F.expr(expression) if isinstance(expression, str) else expression
    if where is None:
        return ~e
    w = F.expr(where) if isinstance(where, str) else where
    return w & ~e


def accepted_range_predicate(col: str, min_value=None, max_value=None) -> Column:
    cond = F.lit(False)
    if min_value is not None:
        cond = cond | (F.col(col) < min_value)
    if max_value is not None:
        cond = cond | (F.col(col) > max_value)
    return cond


def not_null(df: DataFrame, col: str) -> DataFrame:
    """D1."""
    return df.filter(not_null_predicate(col))


def unique(df: DataFrame, col: str) -> DataFrame:
    """Values seen more than once (nulls ignored), with their count.
    Partial aggregation keeps a hot value to one row per map task."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """D3: rows whose value is not in the list (null passes)."""
    return df.filter(accepted_values_predicate(col, values))


def relationships(child: DataFrame, col: str, parent: DataFrame, field_: str) -> DataFrame:
    """Child rows whose key has no parent (null child passes)."""
    keys = parent.select(F.col(field_).alias(col))
    return child.filter(F.col(col).isNotNull()).join(keys, col, "left_anti")


def unique_combination(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Column combinations seen more than once."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)


def expression_is_true(df: DataFrame, expression: str | Column, where: str | Column | None = None) -> DataFrame:
    """Rows (after the optional ``where``) for which the expression is
    false; a null result passes."""
    return df.filter(expression_predicate(expression, where))


def accepted_range(df: DataFrame, col: str, min_value=None, max_value=None) -> DataFrame:
    """Inclusive bounds (null passes)."""
    return df.filter(accepted_range_predicate(col, min_value, max_value))


def place_invariant(fact: DataFrame, dim: DataFrame, pattern: str, key: str = "codigo_snies",
                    place: str = "departamento_ies", year: str = "anio") -> DataFrame:
    """Fact rows whose entity is missing from the dimension or lies
    outside the place pattern (J5: left join, then the null/NOT LIKE test)."""
    j = fact.select(key, year).join(dim.select(key, place), key, "left")
    return j.filter(F.col(place).isNull() | ~matches_place(place, pattern)).select(key, year, place)


def freshness(df: DataFrame, ts_col: str, table: str, warn_days: int, error_days: int,
              as_of: Column | None = None) -> DataFrame:
    """Age of the newest load time; ``ok`` / ``warn`` / ``error``."""
    now = F.current_timestamp() if as_of is None else as_of
    latest = df.agg(F.max(ts_col).alias("max_loaded_at"))
    age = F.floor((F.unix_timestamp(now) - F.unix_timestamp("max_loaded_at")) / 86400).cast("bigint")
    return latest.select(
        F.lit(table).alias("tabla"), "max_loaded_at", age.alias("age_days"),
        F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
         .when(age > error_days, F.lit("error"))
         .when(age > warn_days, F.lit("warn"))
         .otherwise(F.lit("ok")).alias("status"))


@dataclass(frozen=True)
class KeyRule:
    """A uniqueness or relationship check as counts per key of ``table``.

    Without ``child`` a key may occur once (with ``nulls``, null is a value
    like any other; else keys with a null pass); with ``child``, every row of
    it whose key has no null must find its key in ``table``."""

    table: DataFrame
    cols: tuple[str, ...]
    child: DataFrame | None = None
    child_cols: tuple[str, ...] = ()
    nulls: bool = False


@dataclass(frozen=True)
class Check:
    """A named check.  Row-level checks also carry their ``source`` table and
    failing-row ``predicate`` so that all of them on one table are counted in
    a single scan (``count_if`` per check); key checks carry their ``rule`` so
    that all of them, on all tables, are counted in one aggregate."""

    name: str
    table: str
    failing: Callable[[], DataFrame]
    severity: str = "error"
    kind: str = ""
    params: dict = field(default_factory=dict, compare=False)
    source: DataFrame | None = field(default=None, compare=False)
    predicate: Column | None = field(default=None, compare=False)
    rule: KeyRule | None = field(default=None, compare=False)


def row_check(name: str, table: str, source: DataFrame, predicate: Column, kind: str = "row",
              severity: str = "error") -> Check:
    return Check(name, table, lambda: source.filter(predicate), severity, kind, source=source, predicate=predicate)


def unique_check(name: str, table: str, source: DataFrame, col: str, severity: str = "error") -> Check:
    return Check(name, table, lambda: unique(source, col), severity, "unique", rule=KeyRule(source, (col,)))


def unique_combination_check(name: str, table: str, source: DataFrame, cols: Sequence[str],
                             severity: str = "error") -> Check:
    return Check(name, table, lambda: unique_combination(source, cols), severity, "unique_combination",
                 rule=KeyRule(source, tuple(cols), nulls=True))


def relationships_check(name: str, table: str, child: DataFrame, col: str, parent: DataFrame, field_: str,
                        severity: str = "error") -> Check:
    return Check(name, table, lambda: relationships(child, col, parent, field_), severity, "relationships",
                 rule=KeyRule(parent, (field_,), child, (col,)))


#: Types whose text is one to one, so that keys of different tables can share one column.
_INTEGRAL = ("tinyint", "smallint", "int", "bigint")
_EXACT = (*_INTEGRAL, "string", "boolean", "date")


def _is_textual(rule: KeyRule) -> bool:
    """Whether equal keys, and only those, have equal texts."""
    own = [rule.table.schema[c].dataType.simpleString() for c in rule.cols]
    other = [rule.child.schema[c].dataType.simpleString() for c in rule.child_cols] if rule.child is not None else own
    return all(a in _EXACT and (a == b or {a, b} <= set(_INTEGRAL)) for a, b in zip(own, other, strict=True))


def _fuse(checks: Sequence[Check]):
    """Split checks into per-source groups of row-level checks, the group of
    key checks, and the rest."""
    groups: dict[int, list] = {}
    keyed, rest = [], []
    for i, ch in enumerate(checks):
        if ch.source is not None and ch.predicate is not None:
            groups.setdefault(id(ch.source), []).append((i, ch))
        elif ch.rule is not None and _is_textual(ch.rule):
            keyed.append((i, ch))
        else:
            rest.append((i, ch))
    return list(groups.values()), keyed, rest


def key_failures(rules: Sequence[KeyRule]) -> tuple[DataFrame, list[Column]]:
    """Key checks of any number of tables in one aggregate: a DataFrame, and
    for every rule the aggregate of it that counts the failures.

    Every table is read once; a row gives one key for each question asked of
    its table.  The rules on one key of one table share its counts: ``own``
    rows of the table and ``c0``, ``c1``, ... rows of each child.  Keys are
    combined map-side, so a hot one costs one row per map task."""
    domains: dict[tuple, int] = {}
    children: dict[int, list] = {}
    slots = []
    for r in rules:
        d = domains.setdefault((id(r.table), r.cols), len(domains))
        mine = children.setdefault(d, [])
        if r.child is not None:
            mine.append(r)
        slots.append((d, len(mine) - 1))
    width = max(map(len, children.values()))

    def emitted(domain, df, cols, own, slot=None):
        key = F.array(*[F.col(c).cast("string") for c in cols]).alias("key")
        counts = [F.lit(int(slot == k)).cast("bigint").alias(f"c{k}") for k in range(width)]
        return id(df), df, F.struct(F.lit(domain).alias("domain"), key, F.lit(own).cast("bigint").alias("own"), *counts)

    asked: dict[int, tuple] = {}
    seen = set()
    for r, (d, slot) in zip(rules, slots, strict=True):
        if d not in seen:
            seen.add(d)
            i, df, row = emitted(d, r.table, r.cols, 1)
            asked.setdefault(i, (df, []))[1].append(row)
        if r.child is not None:
            i, df, row = emitted(d, r.child, r.child_cols, 0, slot)
            asked.setdefault(i, (df, []))[1].append(row)
    rows = None
    for df, structs in asked.values():
        part = df.select(F.inline(F.array(*structs)))
        rows = part if rows is None else rows.unionByName(part)
    tally = rows.groupBy("domain", "key").agg(*[F.sum(c).alias(c) for c in ("own", *(f"c{k}" for k in range(width)))])
    whole = ~F.exists("key", lambda x: x.isNull())
    out = []
    for r, (d, slot) in zip(rules, slots, strict=True):
        here = F.col("domain") == d
        if r.child is not None:
            out.append(F.coalesce(F.sum(F.when(here & whole & (F.col("own") == 0), F.col(f"c{slot}"))), F.lit(0).cast("bigint")))
        else:
            out.append(F.count_if(here & (F.col("own") > 1) & (F.lit(True) if r.nulls else whole)))
    return tally, out


def _status(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "status", F.when(F.col("failures").isNull(), F.lit("error"))
        .when(F.col("failures") == 0, F.lit("pass"))
        .when(F.col("severity") == "warn", F.lit("warn")).otherwise(F.lit("fail")))


SUMMARY_SCHEMA = "check_name string, tabla string, severity string, failures bigint"


def run_suite(checks: Sequence[Check], store_root: str | None = None, parallelism: int = 8) -> DataFrame:
    """Run every check and return the summary ``(check_name, tabla,
    severity, failures, status)``.

    Checks are independent Spark jobs; like a test runner with worker
    threads, up to ``parallelism`` of them are submitted at once from driver
    threads so that many small jobs share the cluster.  Only the counts (one
    number per check) come back to the driver.  With ``store_root``, the
    failing rows of every check are written to
    ``{store_root}/quality/{check_name}``, replaced on each run - with no rows
    where the check passes - and counted as they are written.  Either way row
    checks cost one scan per table and key checks one aggregate in all; only
    checks that fail read their table again, for their rows.
    """
    from concurrent.futures import ThreadPoolExecutor

    if not checks:
        raise ValueError("no checks to run")
    spark = checks[0].failing().sparkSession

    groups, keyed, rest = _fuse(checks)
    counts: dict[int, int | None] = {}

    def store(item, failing: DataFrame) -> None:
        i, ch = item
        seen = Observation()
        (failing.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
         .option("partitionOverwriteMode", "static").parquet(f"{store_root.rstrip('/')}/quality/{ch.name}"))
        counts[i] = int(seen.get["n"])

    def single(item) -> None:
        i, ch = item
        try:
            if store_root:
                store(item, ch.failing())
            else:
                counts[i] = ch.failing().count()
        except Exception:  # noqa: BLE001 - reported as status "error", the suite goes on
            counts[i] = None

    def fused(group, count) -> None:
        try:
            r = count()
        except Exception:  # noqa: BLE001 - one failing table must not stop the suite: check them one by one
            for item in group:
                single(item)
            return
        for j, (i, ch) in enumerate(group):
            counts[i] = int(r[j])
            if store_root and counts[i]:
                single((i, ch))
            elif store_root:
                spark.createDataFrame([], ch.failing().schema).write.mode("overwrite").option(
                    "partitionOverwriteMode", "static").parquet(f"{store_root.rstrip('/')}/quality/{ch.name}")

    def by_row(group):
        return group[0][1].source.agg(*[F.count_if(ch.predicate).alias(f"c{j}") for j, (_, ch) in enumerate(group)]).first()

    def by_key(group):
        tally, failures = key_failures([ch.rule for _, ch in group])
        return tally.agg(*failures).first()

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        futures = [pool.submit(fused, g, lambda g=g: by_row(g)) for g in groups] + [pool.submit(single, it) for it in rest]
        if keyed:
            futures.append(pool.submit(fused, keyed, lambda: by_key(keyed)))
        for f in futures:
            f.result()
    rows = [(ch.name, ch.table, ch.severity, counts[i]) for i, ch in enumerate(checks)]
    return _status(spark.createDataFrame(rows, SUMMARY_SCHEMA))


def suite_frame(checks: Sequence[Check]) -> DataFrame:
    """D10 as one lazy DataFrame: the union of one-row counts (one job when
    evaluated)."""
    groups, keyed, rest = _fuse(checks)

    def rows(df: DataFrame, group, failures) -> DataFrame:
        each = F.array(*[F.struct(F.lit(ch.name).alias("check_name"), F.lit(ch.table).alias("tabla"),
                                  F.lit(ch.severity).alias("severity"), n.alias("failures"))
                         for (_, ch), n in zip(group, failures, strict=True)])
        return df.agg(each.alias("r")).select(F.explode("r").alias("r")).select("r.*")

    # one scan per source table for all its row-level checks, one aggregate for all key checks
    parts = [rows(g[0][1].source, g, [F.count_if(ch.predicate) for _, ch in g]) for g in groups]
    if keyed:
        tally, failures = key_failures([ch.rule for _, ch in keyed])
        parts.append(rows(tally, keyed, failures))
    for _, ch in rest:
        parts.append(ch.failing().agg(F.count(F.lit(1)).alias("failures"))
                     .select(F.lit(ch.name).alias("check_name"), F.lit(ch.table).alias("tabla"),
                             F.lit(ch.severity).alias("severity"), "failures"))
    summary = parts[0]
    for p in parts[1:]:
        summary = summary.unionByName(p)
    return _status(summary)


class QualityError(Exception):
    pass


def assert_suite(summary: DataFrame) -> list:
    """The suite has run in full; raise if any error-severity check
    failed.  The summary has one row per check, so collecting it is bounded."""
    rows = summary.collect()
    failed = [r for r in rows if r["status"] in ("fail", "error")]
    if failed:
        names = ", ".join(f"{r['check_name']}={r['failures']}" for r in failed)
        raise QualityError(f"{len(failed)} of {len(rows)} checks failed: {names}")
    return rows


def declared_checks(bronze: dict[str, DataFrame], stg_entity: DataFrame, stg_numer: DataFrame,
                    stg_denom: DataFrame, seed: DataFrame, dim: DataFrame, tiempo: DataFrame, fact: DataFrame,
                    cfg: StarConfig = DOMAIN, seed_columns: Sequence[str] = ("codigo_snies", "nombre_oficial",
                                                                            "universidad_sue")) -> list[Check]:
    """The 49 declared tests of the star (2+2 Bronze, 3 stg_entity, 8 + 7
    yearly measures, 4 seed, 7 dim, 3 time, 12 fact, 1 custom)."""
    c = cfg
    n, d, r = c.numerator.total, c.denominator.total, c.ratio
    years = list(c.accepted_years)
    out: list[Check] = []

    def row(name, table, kind, df, pred):
        out.append(row_check(name, table, df, pred, kind))

    nn, av = not_null_predicate, accepted_values_predicate
    for tname, df in bronze.items():
        for col in (c.code, c.year):
            row(f"not_null_{tname}_{col}", tname, "not_null", df, nn(col))
    row("not_null_stg_ies_codigo_snies", "stg_ies", "not_null", stg_entity, nn("codigo_snies"))
    out.append(unique_check("unique_stg_ies_codigo_snies", "stg_ies", stg_entity, "codigo_snies"))
    row("not_null_stg_ies_nombre_ies", "stg_ies", "not_null", stg_entity, nn("nombre_ies"))
    for tname, df, total, with_range in (("stg_matriculados", stg_numer, n, True),
                                         ("stg_docentes", stg_denom, d, False)):
        row(f"not_null_{tname}_codigo_snies", tname, "not_null", df, nn("codigo_snies"))
        out.append(relationships_check(f"relationships_{tname}_codigo_snies", tname, df, "codigo_snies", stg_entity,
                                       "codigo_snies"))
        row(f"not_null_{tname}_anio", tname, "not_null", df, nn("anio"))
        row(f"accepted_values_{tname}_anio", tname, "accepted_values", df, av("anio", years))
        row(f"not_null_{tname}_{total}", tname, "not_null", df, nn(total))
        row(f"expression_is_true_{tname}_{total}", tname, "expression_is_true", df,
            expression_predicate(f"{total} >= 0"))
        if with_range:
            lo, hi = c.semester_range
            row(f"accepted_range_{tname}_semestres_presentes", tname, "accepted_range", df,
                accepted_range_predicate("semestres_presentes", lo, hi))
        out.append(unique_combination_check(f"unique_combination_{tname}", tname, df, ["codigo_snies", "anio"]))
    sk = seed_columns[0]
    row(f"not_null_seed_{sk}", "seed", "not_null", seed, nn(sk))
    out.append(unique_check(f"unique_seed_{sk}", "seed", seed, sk))
    for col in seed_columns[1:]:
        row(f"not_null_seed_{col}", "seed", "not_null", seed, nn(col))
    row("not_null_dim_ies_codigo_snies", "dim_ies", "not_null", dim, nn("codigo_snies"))
    out.append(unique_check("unique_dim_ies_codigo_snies", "dim_ies", dim, "codigo_snies"))
    row("not_null_dim_ies_nombre_ies", "dim_ies", "not_null", dim, nn("nombre_ies"))
    row("accepted_values_dim_ies_sector_ies", "dim_ies", "accepted_values", dim, av("sector_ies", c.sector_accepted))
    row("accepted_values_dim_ies_caracter_ies", "dim_ies", "accepted_values", dim,
        av("caracter_ies", c.caracter_accepted))
    row("not_null_dim_ies_es_sue", "dim_ies", "not_null", dim, nn("es_sue"))
    row("accepted_values_dim_ies_es_sue", "dim_ies", "accepted_values", dim, av("es_sue", [True, False]))
    row("not_null_dim_tiempo_anio", "dim_tiempo", "not_null", tiempo, nn("anio"))
    out.append(unique_check("unique_dim_tiempo_anio", "dim_tiempo", tiempo, "anio"))
    row("accepted_values_dim_tiempo_anio", "dim_tiempo", "accepted_values", tiempo, av("anio", years))
    row("not_null_fact_codigo_snies", "fact", "not_null", fact, nn("codigo_snies"))
    out.append(relationships_check("relationships_fact_codigo_snies", "fact", fact, "codigo_snies", dim,
                                   "codigo_snies"))
    row("not_null_fact_anio", "fact", "not_null", fact, nn("anio"))
    out.append(relationships_check("relationships_fact_anio", "fact", fact, "anio", tiempo, "anio"))
    for total in (n, d):
        row(f"not_null_fact_{total}", "fact", "not_null", fact, nn(total))
        row(f"expression_is_true_fact_{total}", "fact", "expression_is_true", fact,
            expression_predicate(f"{total} >= 0"))
    row(f"expression_is_true_fact_{r}", "fact", "expression_is_true", fact,
        expression_predicate(f"{r} >= 0", f"{r} IS NOT NULL"))
    row(f"not_null_fact_{c.flag}", "fact", "not_null", fact, nn(c.flag))
    row(f"accepted_values_fact_{c.flag}", "fact", "accepted_values", fact, av(c.flag, c.flags))
    out.append(unique_combination_check("unique_combination_fact", "fact", fact, ["codigo_snies", "anio"]))
    out.append(Check("fact_only_in_place", "fact", lambda: place_invariant(fact, dim, c.place_pattern), kind="custom"))
    return out
