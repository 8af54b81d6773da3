"""Line deduplication by overlapping windows of three lines.

A text is cut at ``\\n``. Every three consecutive lines form a window; a window is
known by the hashes of its three lines (192 bits together). Of all places in
the corpus where a window occurs, the first one (by id, then text hash, then
position; null ids first) stays. All later ones are covered; overlapping
covered windows merge, and the covered lines go. Windows of blank lines only
don't count.

With ``passage_words``, windows of one and of two lines that hold more than so many
words (stretches without white space) count too, each against windows of as many lines, so
that a passage is also found where it repeats without a third line. It is off by default:
the SQL of ``op2_line_dedup`` and the brute force of the pipeline's stage know windows of three lines only.

Everything is DataFrame operations. Counting windows combines on the map side, so
a passage that a third of the documents share costs a row per task. The
windows that repeat are written as a table; the join with them lets AQE split a hot
window. Texts are moved once, to meet their covered positions.

Defined cases: null and empty texts have no window and stay as they are, as do texts of one or two
lines without a passage; rows that repeat an id and a text count as one document and are
treated alike, whatever their number; an empty table gives no rows. A text of
which no line is left becomes empty (``n_left`` 0).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mobility.llm.common import free_name, written

WINDOW = 3
#: Words that a passage of under three lines exceeds; for ``passage_words``.
PASSAGE_WORDS = 50
_KEYS = ["n", *[f"h{k}" for k in range(WINDOW)]]


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_windows(df: DataFrame, id_col: str = "doc_id", text: str = "text", passage_words: int | None = None) -> DataFrame:
    """``id, th, pos, n, h0..`` of every window; ``pos`` counts lines from 0, ``n`` is the window's
    number of lines, and hashes beyond it are 0."""
    shortest = WINDOW if passage_words is None else 1
    lines = df.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("th"),
                      _lines(F.col(f"`{text}`")).alias("lines")).where(F.size("lines") >= shortest)
    words = [] if passage_words is None else [F.transform("lines", lambda x: F.regexp_count(x, F.lit(r"\S+"))).alias("words")]
    hashed = lines.select("id", "th", F.transform("lines", lambda x: F.xxhash64(x)).alias("hashes"),
                          F.transform("lines", lambda x: F.trim(x) == "").alias("blank"), *words)

    def windows(n: int, counts) -> Column:
        starts = F.when(F.size("hashes") >= n, F.sequence(F.lit(1), F.size("hashes") - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(F.filter(starts, counts), lambda i: F.struct(
            (i - 1).alias("pos"), F.lit(n).alias("n"),
            *[(F.element_at("hashes", i + k) if k < n else F.lit(0).cast("long")).alias(f"h{k}") for k in range(WINDOW)]))

    def holds_passage(n: int):
        return lambda i: F.aggregate(F.slice("words", i, n), F.lit(0), lambda a, x: a + x) > passage_words

    found = [windows(WINDOW, lambda i: ~F.forall(F.slice("blank", i, WINDOW), lambda b: b))]
    if passage_words is not None:
        found += [windows(n, holds_passage(n)) for n in range(1, WINDOW)]
    return hashed.select("id", "th", F.explode(F.concat(*found)).alias("w")).select("id", "th", "w.*")


def covered_positions(df: DataFrame, id_col: str = "doc_id", text: str = "text", passage_words: int | None = None) -> DataFrame:
    """``id, th, covered``: the sorted line positions that go, of each document that loses any."""
    windows = line_windows(df, id_col, text, passage_words)
    place = F.struct("id", "th", "pos")
    first = written(windows.groupBy(*_KEYS).agg(F.min(place).alias("first"), F.max(place).alias("last"))
                    .where("first != last").select(*_KEYS, "first"), "line-windows")
    later = windows.join(first, _KEYS).where(place > F.col("first"))
    starts = later.groupBy("id", "th").agg(F.collect_set(F.struct("pos", "n")).alias("starts"))
    merged = F.array_distinct(F.flatten(F.transform("starts", lambda p: F.sequence(p["pos"], p["pos"] + p["n"] - 1))))
    return starts.select("id", "th", F.array_sort(merged).alias("covered"))


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text: str = "text", removed: str = "n_removed",
                left: str = "n_left", passage_words: int | None = None) -> DataFrame:
    """``df`` with ``text`` less its covered lines, and the numbers of lines that went and stayed."""
    covered = covered_positions(df, id_col, text, passage_words)
    th, cov = free_name(df, "th"), free_name(df, "covered")
    key = covered.select(F.col("id").alias("__id"), F.col("th").alias("__th"), F.col("covered").alias(cov))
    joined = (df.withColumn(th, F.xxhash64(F.col(f"`{text}`")))
              .join(key, F.col(f"`{id_col}`").eqNullSafe(F.col("__id")) & (F.col(th) == F.col("__th")), "left"))
    lines = _lines(F.col(f"`{text}`"))
    stays = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(cov))
    kept = F.transform(stays, lambda i: F.get(lines, i))
    columns = [c for c in df.columns if c.lower() not in (removed.lower(), left.lower())]
    n_lines = F.coalesce(F.when(F.col(f"`{text}`").isNotNull(), F.size(lines)), F.lit(0))
    n_gone = F.coalesce(F.when(F.col(cov).isNotNull(), F.size(cov)), F.lit(0))
    return joined.select(
        *[F.when(F.col(cov).isNull(), F.col(f"`{c}`")).otherwise(F.array_join(kept, "\n")).alias(c)
          if c == text else F.col(f"`{c}`") for c in columns],
        n_gone.cast("long").alias(removed), (n_lines - n_gone).cast("long").alias(left))


#: DuckDB: the same rows from the lines themselves instead of their hashes.
ORACLE = """
WITH line AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS l,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
  FROM documents
), win AS (
  SELECT doc_id, pos, l AS l0,
         lead(l, 1) OVER (PARTITION BY doc_id ORDER BY pos) AS l1,
         lead(l, 2) OVER (PARTITION BY doc_id ORDER BY pos) AS l2
  FROM line
), later AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY l0, l1, l2 ORDER BY doc_id, pos) AS occurrence
  FROM win WHERE l2 IS NOT NULL AND NOT (trim(l0, ' ') = '' AND trim(l1, ' ') = '' AND trim(l2, ' ') = '')
), gone AS (
  SELECT DISTINCT doc_id, pos + k AS pos FROM later, (VALUES (0), (1), (2)) v(k) WHERE occurrence > 1
), merged AS (
  SELECT line.doc_id, count(gone.pos) AS n_removed, count(*) - count(gone.pos) AS n_left,
         coalesce(string_agg(CASE WHEN gone.pos IS NULL THEN l END, chr(10) ORDER BY line.pos), '') AS text
  FROM line LEFT JOIN gone ON line.doc_id = gone.doc_id AND line.pos = gone.pos
  GROUP BY line.doc_id
)
SELECT doc_id, text, CAST(n_removed AS BIGINT) AS n_removed, CAST(n_left AS BIGINT) AS n_left FROM merged
"""
