"""Ingest operators S5-S15 over a cell grid ``(source_file, row_idx, cells)``.

The flow (one lazy plan apart from the per-file header resolution):

1. ``resolve_headers``: one pass over the head of every file maps each
   head row's cells to canonical names (S6, S7) and scores them against the
   aliases (S5); the first row per file of one ordering is its header.  A file
   whose declared row misses a required column falls back to the best row
   (score >= 4, first row on ties, and only if it differs); missing columns
   (S9) or two headers mapping to one name fail, listing what is available.
   The decisions are a stored table, one row per file; the driver sees the
   distinct column names and the files that fail or fall back.
2. ``extract_rows``: data rows below the header; junk rows whose key cell is
   not all digits are dropped (S10, tested on the raw cell); null tokens
   (S11) and then trimming (S12) are applied to every cell with
   higher-order functions; the row hash (S13) is computed over the cleaned
   cells in file column order; canonical columns are picked by position.
3. ``add_lineage`` (S14); ``extract`` composes all of it (S15).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aulastar.config import (
    HASH_SEPARATOR, HEADER_MIN_SCORE, HEADER_SCAN_ROWS, MISSING_HASH_TEXT, NULL_TOKENS, IngestProfile,
)
from aulastar.functions import is_digits, normalize_header, null_tokens, snake_case, trim_unicode
from aulastar.session import remove_at_exit, shared_path


ROW_SPAN = 1 << 40   # row numbers of one file stay below this


def _alias_map(aliases: Mapping[str, str]) -> Column:
    kv = []
    for k, v in aliases.items():
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv)


def _scored(grid: DataFrame, alias_keys: Sequence[str], max_rows: int) -> DataFrame:
    """Rows of the scan window that hold a known alias: ``score`` of them."""
    keys = list(alias_keys)
    hits = F.aggregate(
        F.transform("cells", lambda x: F.when(x.isNotNull() & normalize_header(x).isin(keys), 1).otherwise(0)),
        F.lit(0), lambda acc, x: acc + x)
    head = grid.filter(F.col("row_idx") < max_rows)
    return head.select("source_file", "row_idx", "cells", hits.alias("score")).filter(F.col("score") > 0)


def _first_per_file(rows: DataFrame, *order: Column) -> DataFrame:
    """One row per file, the first in ``order``.  ``row_number() = 1`` is a partial ``WindowGroupLimit`` before the exchange, so
    a file sends one row per task, its cells with it, and the head is evaluated once."""
    w = Window.partitionBy("source_file").orderBy(*order)
    return rows.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def detect_header(grid: DataFrame, alias_keys: Sequence[str], max_rows: int = HEADER_SCAN_ROWS,
                  min_score: int = HEADER_MIN_SCORE, with_cells: bool = False) -> DataFrame:
    """Per file, the row among the first ``max_rows`` with the most cells
    whose normalised text is a known alias; the first row wins ties; files
    whose best score is below ``min_score`` get no row.

    Output ``(source_file, header_row, score)`` (+ ``cells`` of that row with
    ``with_cells``, so the header can be mapped without a second pass).
    Scores are a per-row expression; the per-file choice is a maximum, which
    combines map-side (with cells: the first row of a window, limited map-side).
    """
    scored = _scored(grid, alias_keys, max_rows)
    if with_cells:
        return _first_per_file(scored.filter(F.col("score") >= min_score), F.col("score").desc(), F.col("row_idx").asc()).select(
            "source_file", F.col("row_idx").alias("header_row"), "score", "cells")
    # score and row in one number: the aggregate's buffer is a long (a hash
    # aggregate), and no cells are shuffled
    packed = F.col("score").cast("long") * F.lit(ROW_SPAN) + (F.lit(ROW_SPAN - 1) - F.col("row_idx"))
    best = scored.groupBy("source_file").agg(F.max(packed).alias("b"))
    best = best.select("source_file", (F.lit(ROW_SPAN - 1) - F.col("b") % ROW_SPAN).alias("header_row"),
                       F.floor(F.col("b") / ROW_SPAN).cast("int").alias("score")).filter(F.col("score") >= min_score)
    return best


def detected_header_cells(grid: DataFrame, alias_keys: Sequence[str], max_rows: int = HEADER_SCAN_ROWS,
                          min_score: int = HEADER_MIN_SCORE) -> DataFrame:
    """S5 then the cells of the detected row, one row per cell
    ``(source_file, header_row, position, header)``, in one pass."""
    d = detect_header(grid, alias_keys, max_rows, min_score, with_cells=True)
    return d.select("source_file", "header_row", F.posexplode("cells").alias("position", "header"))


def header_cells(grid: DataFrame, header_rows: DataFrame) -> DataFrame:
    """The header row of each file, one row per cell:
    ``(source_file, header_row, position, header)``.  ``header_rows`` has one
    row per file."""
    h = grid.join(header_rows.select("source_file", "header_row"), "source_file")
    h = h.filter(F.col("row_idx") == F.col("header_row"))
    return h.select("source_file", "header_row", F.posexplode("cells").alias("position", "header"))


def map_columns(headers: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """S6 + S7 (+ X14): add ``key`` (normalised header), ``canonical`` (alias
    or snake_case of the key; ``_c<pos>`` for an empty header cell) and
    ``mapped`` (the key is a known alias)."""
    # the key is projected first and then referenced: it is computed once per
    # cell (the optimizer does not inline a non-trivial expression used twice)
    keyed = headers.select("*", normalize_header("header").alias("key"))
    keyed = keyed.select("*", F.element_at(_alias_map(aliases), F.col("key")).alias("__alias"))
    key = F.col("key")
    canonical = (F.when(F.col("header").isNull() | (key == ""), F.concat(F.lit("_c"), F.col("position").cast("string")))
                 .otherwise(F.coalesce(F.col("__alias"), snake_case(key))))
    return keyed.select(*headers.columns, "key", canonical.alias("canonical"),
                        F.col("__alias").isNotNull().alias("mapped"))


def _canonical_names(cells: Column, keys: Column, amap: Column) -> Column:
    """S6 + S7 of the cells of one header row, as an array: see ``map_columns``."""
    return F.transform(keys, lambda k, i: F.when(F.get(cells, i).isNull() | (k == ""), F.concat(F.lit("_c"), i.cast("string")))
                       .otherwise(F.coalesce(F.element_at(amap, k), snake_case(k))))


def map_header_rows(rows: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """S6 + S7 of whole header rows: ``cells`` becomes ``names``, the canonical
    name of every cell as ``map_columns`` gives it."""
    keyed = rows.withColumn("__keys", F.transform("cells", lambda x: normalize_header(x)))
    return keyed.withColumn("names", _canonical_names(F.col("cells"), F.col("__keys"), _alias_map(aliases))).drop("cells", "__keys")


def mapped_report(mapped: DataFrame) -> DataFrame:
    """``mapped / total`` header cells per file."""
    return (mapped.groupBy("source_file")
            .agg(F.count_if(F.col("mapped")).alias("mapped"), F.count(F.lit(1)).alias("total")))


def missing_required(mapped: DataFrame, required: Sequence[str]) -> DataFrame:
    """Per file, the required canonical columns that are absent (sorted)
    and the number of distinct available names.

    ``mapped`` has the ``names`` of a file's header row in one row
    (``map_header_rows``): each is worked out by itself, and no task holds the
    names of more than one.  One row per cell (``map_columns``) is brought
    together by file first."""
    if "names" not in mapped.columns:
        mapped = mapped.groupBy("source_file").agg(F.collect_set("canonical").alias("names"))
    req = F.array(*[F.lit(r) for r in sorted(set(required))]).cast("array<string>")
    return mapped.select("source_file", F.array_except(req, "names").alias("missing"),
                         F.size(F.array_distinct("names")).alias("n_available"))


@dataclass
class ResolvedHeaders:
    frame: DataFrame          # source_file, header_row, names array<string>, width int
    columns: list[str]        # union of canonical names, in first-seen position order
    fallback_files: list[str]  # files whose header row came from detection
    errors: dict[str, str] = field(default_factory=dict)  # files without a usable header, and why


class HeaderError(ValueError):
    pass


def resolve_headers(grid: DataFrame, declared: DataFrame, profile: IngestProfile,
                    max_rows: int = HEADER_SCAN_ROWS, min_score: int = HEADER_MIN_SCORE,
                    strict: bool = True, head: DataFrame | None = None) -> ResolvedHeaders:
    """Header row and canonical names per file (see module doc, step 1).

    A file without a usable header fails alone: with ``strict`` a
    ``HeaderError`` names all such files, otherwise they are left out and
    listed in ``errors``.

    ``declared`` has ``(source_file, header_row)`` per file.  ``head`` is the
    beginning of the grid where the caller can read that alone (see
    ``read_csv_head``); it must reach the scan window and every declared row.
    """
    spark = declared.sparkSession
    decided = header_decisions(grid if head is None else head, declared, profile, max_rows, min_score)
    path = shared_path(spark, "aulastar-headers", uuid.uuid4().hex)
    decided.write.parquet(path)   # read three times below and by the extraction
    remove_at_exit(spark, path)
    decided = spark.read.schema(decided.schema).parquet(path)
    odd = decided.filter(F.col("error").isNotNull() | F.col("fallback")).select("source_file", "error").collect()  # files that fail or fall back
    errors = {r["source_file"]: r["error"] for r in odd if r["error"] is not None}
    if errors and strict:
        raise HeaderError("\n".join(f"{f}: {m}" for f, m in sorted(errors.items())))
    good = decided.filter(F.col("error").isNull())
    place = F.struct("source_file", "pos")
    columns = (good.select("source_file", F.posexplode("names").alias("pos", "name")).groupBy("name").agg(F.min(place).alias("at"))
               .orderBy("at").select("name").collect())   # distinct names
    fallback = sorted(r["source_file"] for r in odd if r["error"] is None)
    return ResolvedHeaders(good.select("source_file", "header_row", "names", "width"), [r["name"] for r in columns], fallback, errors)


def header_decisions(grid: DataFrame, declared: DataFrame, profile: IngestProfile, max_rows: int = HEADER_SCAN_ROWS,
                     min_score: int = HEADER_MIN_SCORE) -> DataFrame:
    """``(source_file, header_row, names, width, fallback, error)`` of every
    declared file, as one plan over the head of the grid."""
    decl = declared.select("source_file", F.col("header_row").cast("bigint").alias("__decl"))
    last = max(max_rows - 1, declared.agg(F.max("header_row")).first()[0] or 0)   # so that only heads are joined
    head = (grid.filter(F.col("row_idx") <= last).join(decl, "source_file").filter((F.col("row_idx") < max_rows) | (F.col("row_idx") == F.col("__decl")))
            .withColumn("cells", number_repeats(F.col("cells"))))
    amap = _alias_map(profile.aliases)
    keyed = head.select("source_file", "row_idx", "__decl", "cells",
                        F.transform("cells", lambda x: normalize_header(x)).alias("keys"))
    names = _canonical_names(F.col("cells"), F.col("keys"), amap)
    score = F.size(F.filter(F.arrays_zip("cells", "keys"),
                            lambda z: z["cells"].isNotNull() & F.element_at(amap, z["keys"]).isNotNull()))
    rows = keyed.select("source_file", "row_idx", "__decl", names.alias("names"), score.alias("score"))
    required = F.array(*[F.lit(c) for c in profile.required]).cast("array<string>")
    is_declared = F.coalesce(F.col("row_idx") == F.col("__decl"), F.lit(False))
    serves = is_declared & (F.size(F.array_except(required, "names")) == 0)
    scores = (F.col("row_idx") < max_rows) & (F.col("score") >= min_score)
    # the declared row if it serves, else the row that scores best (which may be the declared one), else the declared row
    first = _first_per_file(rows.filter(is_declared | scores), serves.desc(), scores.desc(), F.when(scores, F.col("score")).desc(), F.col("row_idx").asc())
    chosen = first.withColumn("missing", F.array_except(required, "names"))
    quoted = lambda a: F.concat(F.lit("['"), F.array_join(a, "', '"), F.lit("']"))
    lacks = F.lit(f"required columns missing for profile '{profile.name}': ")
    twice = F.array_sort(F.array_distinct(F.filter("names", lambda x: F.size(F.filter(F.col("names"), lambda y: y == x)) > 1)))
    error = (F.when(F.col("row_idx").isNull(), F.concat(lacks, F.lit("header row "), F.coalesce(F.col("d").cast("string"), F.lit("None")), F.lit(" not found in the file")))
             .when(F.size("missing") > 0, F.concat(lacks, F.lit("missing "), quoted(F.col("missing")), F.lit("; available "), quoted(F.array_sort(F.array_distinct("names")))))
             .when(F.size(F.array_distinct("names")) < F.size("names"), F.concat(F.lit("headers mapping to the same name "), quoted(twice))))
    every = decl.select("source_file", F.col("__decl").alias("d")).join(chosen, "source_file", "left")
    return every.select("source_file", F.col("row_idx").alias("header_row"), "names", F.size("names").alias("width"),
                        (~F.col("row_idx").eqNullSafe(F.col("d"))).alias("fallback"), error.alias("error"))


def number_repeats(cells: Column) -> Column:
    """The cells of a header row, the n-th repeat of an identical text marked
    ``.n``, as the tabular reader does: two equal headers are two columns."""
    before = lambda x, i: F.size(F.filter(F.slice(cells, F.lit(1), i), lambda y: y == x))
    return F.transform(cells, lambda x, i: F.when(x.isNull() | (before(x, i) == 0), x)
                       .otherwise(F.concat(x, F.lit("."), before(x, i).cast("string"))))


def clean_cells(cells: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """S11 then S12 on every cell of an array (exact null tokens first, then
    Unicode trim: a blank-only cell ends as ``""``, not null)."""
    return F.transform(cells, lambda x: trim_unicode(null_tokens(x, tokens)))


def grid_row_hash(cells: Column) -> Column:
    """S13 over an array of (cleaned) cells: MD5 of the values joined with
    ``||``, a missing value printing as ``nan``."""
    return F.md5(F.array_join(F.transform(cells, lambda x: F.coalesce(x, F.lit(MISSING_HASH_TEXT))),
                              HASH_SEPARATOR))


def extract_rows(grid: DataFrame, resolved: ResolvedHeaders, key: str,
                 tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Data rows with canonical columns, cleaned, plus ``_row_hash`` and
    ``_source_file`` (module doc, step 2)."""
    # where each output column stands in its file, worked out once per file
    places = F.array(*[F.array_position("names", name).cast("int") - 1 for name in resolved.columns])
    files = resolved.frame.select("source_file", "header_row", "width", places.alias("places"),
                                  (F.array_position("names", key).cast("int") - 1).alias("key_place"))
    g = grid.join(files, "source_file").filter(F.col("row_idx") > F.col("header_row"))
    g = g.filter(is_digits(F.get(F.col("cells"), F.col("key_place"))))
    full = F.transform(F.sequence(F.lit(0), F.col("width") - 1), lambda i: F.get(F.col("cells"), i))
    g = g.select("source_file", "places", clean_cells(full, tokens).alias("clean"))
    hashed = grid_row_hash(F.col("clean"))
    cols = [F.get(F.col("clean"), F.get(F.col("places"), i)).alias(name) for i, name in enumerate(resolved.columns)]
    return g.select(*cols, hashed.alias("_row_hash"), F.col("source_file").alias("_source_file"))


def add_lineage(df: DataFrame, run_id: str, source_url: Column | str | None = None,
                ingested_at: Column | None = None) -> DataFrame:
    """``_ingested_at``, ``_source_url``, ``_dag_run_id`` (``_source_file``
    and ``_row_hash`` come from ``extract_rows``)."""
    url = source_url if isinstance(source_url, Column) else F.lit(source_url).cast("string")
    return df.withColumns({
        "_ingested_at": F.current_timestamp() if ingested_at is None else ingested_at,
        "_source_url": url,
        "_dag_run_id": F.lit(run_id),
    })


def extract(grid: DataFrame, catalog: DataFrame, profile: IngestProfile, run_id: str,
            ingested_at: Column | None = None, strict: bool = True, head: DataFrame | None = None) -> tuple[DataFrame, ResolvedHeaders]:
    """Catalog -> headers -> rows -> lineage for one profile.

    ``catalog`` has ``filename``, ``header_row``, ``url`` and ``perfil``;
    only files of ``profile`` are read (their ``head`` for the headers, where
    given).  Returns the Bronze-ready rows and
    the resolved headers (for the mapped-column report).
    """
    cat = (catalog.filter(F.col("perfil") == profile.name)
           .select(F.col("filename").alias("source_file"), "header_row", "url"))
    grid = grid.join(cat.select("source_file"), "source_file", "left_semi")
    resolved = resolve_headers(grid, cat.select("source_file", "header_row"), profile, strict=strict, head=head)
    rows = extract_rows(grid, resolved, profile.key)
    rows = rows.join(cat.select(F.col("source_file").alias("_source_file"), "url"), "_source_file")
    out = add_lineage(rows, run_id, F.col("url"), ingested_at).drop("url")
    lineage = ["_ingested_at", "_source_url", "_source_file", "_row_hash", "_dag_run_id"]
    return out.select(*resolved.columns, *lineage), resolved
