"""Spelling variants by permuterm rotations.

Every word, closed by a terminator, is rotated to each of its places.  A word
``u c v`` has a rotation ``v $ u c``: without its last character it is the prefix
``v $ u``, which all words share that differ in this character only, and which is
a whole rotation of the word ``u v`` that lacks it.  With the rotations sorted by
such prefixes, one scan of each prefix's range sees all neighbours by
replacement, insertion and deletion.

A range has at most one row per letter of the alphabet and one whole rotation, so
its size is bounded however often words occur.  Nothing is paired: a row's
neighbours in a range are a count and the best of the others (the first of the
range, or the second for the first itself), and a word adds up its
ranges.  A replacement is seen in one range only; a deletion from a run of equal characters
would be seen in several, so only the first character of each run counts for it.

Defined cases: null and empty texts have no words; a null id is written as nothing
before the colon of the hashed name; repeated rows count each; an empty table gives no rows;
only the id and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

RUN = r"([A-Za-zÀ-ÿ]+)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERMINATOR = "$"
SLIP = 199
MIN_LENGTH = 6
MIN_COUNT = 5
FACTOR = 5


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slip: int | None = SLIP) -> DataFrame:
    """(word): every lower-cased run of letters; with ``slip``, runs whose hash with the id it divides
    lose one character, chosen by that hash."""
    found = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"),
        F.explode(F.regexp_extract_all(F.translate(text_col, UPPER, LOWER), F.lit(RUN))).alias("word"),
    )
    if not slip:
        return found.select("word")
    h = F.crc32(F.concat("_id", F.lit(":"), "word").cast("binary"))
    place = F.pmod(F.col("_h"), F.length("word")).cast("int")
    shorter = F.concat(F.substr("word", F.lit(1), place), F.substr("word", place + 2))
    return found.withColumn("_h", h).select(F.when(F.col("_h") % slip == 0, shorter).otherwise(F.col("word")).alias("word"))


def vocabulary(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words of ``min_length`` characters or more that occur ``min_count`` times or more."""
    long = words.where(F.length("word") >= min_length)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def rotations(vocab: DataFrame) -> DataFrame:
    """(key, whole, first_of_run, word, n): the rotations of each word, whole ones and those without
    the character at which they begin anew."""
    end, place = F.lit(TERMINATOR), F.col("_i")

    def before(at: Column) -> Column:
        return F.substr("word", F.lit(1), at)

    whole = vocab.select("word", "n", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("_i")).select(
        F.concat(F.substr("word", place + 1), end, before(place)).alias("key"),
        F.lit(True).alias("whole"),
        F.lit(False).alias("first_of_run"),
        "word",
        "n",
    )
    skipped = vocab.select("word", "n", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("_i")).select(
        F.concat(F.substr("word", place + 1), end, before(place - 1)).alias("key"),
        F.lit(False).alias("whole"),
        ((place == 1) | (F.substr("word", place, F.lit(1)) != F.substr("word", place - 1, F.lit(1)))).alias("first_of_run"),
        "word",
        "n",
    )
    return whole.unionByName(skipped)


def neighbours(vocab: DataFrame) -> DataFrame:
    """(word, n_near, near, near_n) of the words that have a near word; ``near`` is the one of
    largest n, of equal ones the smallest."""
    sorted_range = Window.partitionBy("key").orderBy("whole", F.desc("n"), "word")
    everything = sorted_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    candidate = F.struct("n", "word")
    skipped = ~F.col("whole")
    scanned = rotations(vocab).select(
        "*",
        F.row_number().over(sorted_range).alias("_rank"),
        F.count(F.when(skipped, 1)).over(everything).alias("_skipped"),
        F.first(F.when(skipped, candidate)).over(everything).alias("_first"),
        F.nth_value(F.when(skipped, candidate), 2).over(everything).alias("_second"),
        F.last(F.when(F.col("whole"), candidate)).over(everything).alias("_whole"),
        F.count(F.when(F.col("first_of_run"), 1)).over(everything).alias("_longer"),
        F.first(F.when(F.col("first_of_run"), candidate), ignorenulls=True).over(everything).alias("_longest"),
    )
    shorter = F.when(F.col("first_of_run"), F.col("_whole"))
    other = F.when(F.col("_rank") == 1, F.col("_second")).otherwise(F.col("_first"))
    near = scanned.select(
        "word",
        F.when(F.col("whole"), F.col("_longer")).otherwise(F.col("_skipped") - 1 + F.when(shorter.isNotNull(), 1).otherwise(0)).alias("_count"),
        F.when(F.col("whole"), F.array("_longest")).otherwise(F.array(other, shorter)).alias("_best"),
    ).where("_count > 0")
    # of all candidates the largest n, then the smallest word: ordered by (-n, word)
    ordered = F.array_min(
        F.transform(F.filter("_best", lambda x: x.isNotNull()), lambda x: F.struct((-x["n"]).alias("m"), x["word"].alias("w")))
    )
    per = near.select("word", "_count", ordered.alias("_o")).groupBy("word").agg(F.sum("_count").alias("n_near"), F.min("_o").alias("_o"))
    return per.select("word", "n_near", F.col("_o.w").alias("near"), (-F.col("_o.m")).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the end of each chain of forms.  Chains are followed by
    doubling; a form's count is a multiple of its word's, so they are short and have no circles."""
    ahead = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        step = ahead.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        followed = cut_lineage(ahead.join(step, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        if followed.where("_moved").isEmpty():
            return followed.select("word", "root")
        ahead = followed.select("word", "root")


def spelling_variants(vocab: DataFrame, factor: int = FACTOR) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for (word, n): a word's form is its near word of
    largest n, where that is ``factor`` times the word's n or more."""
    vocab = cut_lineage(vocab)
    has_form = F.col("near_n") >= factor * F.col("n")
    judged = cut_lineage(
        vocab.join(neighbours(vocab), "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has_form, F.col("near")).alias("form"),
            F.when(has_form, F.col("near_n")).alias("form_n"),
        )
    )
    found = roots(judged.where("form is not null"))
    return judged.join(found, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op13_spelling(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return spelling_variants(vocabulary(runs(docs))).select("word", "form", "root", "n", "n_near", "form_n")


ORACLE_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i::UBIGINT, range(8)::UBIGINT[]),
                          lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END) AS c
    FROM range(256) x(i))
), r AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[A-Za-z\x{C0}-\x{FF}]+')) AS w
  FROM documents
), pairs AS (
  SELECT w, count(*) AS k, encode(id || ':' || w) AS b FROM r GROUP BY id, w
), hashed AS (
  SELECT w, k, xor(list_reduce(list_prepend(4294967295::UBIGINT,
      list_transform(range(octet_length(b)), lambda i: CAST('0x' || substr(hex(b), 2 * i + 1, 2) AS UBIGINT))),
      lambda a, c: xor(a >> 8, tab[CAST(xor(a & 255, c) AS INT) + 1])), 4294967295::UBIGINT) AS h
  FROM pairs, crc
), vocab AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n
  FROM (SELECT k, CASE WHEN h % 199 = 0
                       THEN substr(w, 1, CAST(h % length(w) AS INT)) || substr(w, CAST(h % length(w) AS INT) + 2) ELSE w END AS word
        FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5
), gaps AS (
  SELECT word, n, i, substr(word, 1, CAST(i AS INT) - 1) AS u, substr(word, CAST(i AS INT) + 1) AS v
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocab)
), near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM gaps a JOIN gaps b ON a.u = b.u AND a.v = b.v AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM gaps a JOIN vocab b ON a.u || a.v = b.word
  UNION SELECT b.word, a.word, a.n FROM gaps a JOIN vocab b ON a.u || a.v = b.word
), best AS (
  SELECT word, count(*) AS n_near, max(m) AS top, first(other ORDER BY m DESC, encode(other)) AS form FROM near GROUP BY word
), judged AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN top >= 5 * v.n THEN form END AS form, CASE WHEN top >= 5 * v.n THEN top END AS form_n
  FROM vocab v LEFT JOIN best b ON v.word = b.word
), chain AS (
  SELECT word, word AS at FROM judged
  UNION ALL SELECT c.word, j.form FROM chain c JOIN judged j ON c.at = j.word WHERE j.form IS NOT NULL
), ends AS (
  SELECT c.word, c.at AS root FROM chain c JOIN judged j ON c.at = j.word WHERE j.form IS NULL
)
SELECT j.word, j.form, e.root, j.n, CAST(j.n_near AS BIGINT) AS n_near, CAST(j.form_n AS BIGINT) AS form_n
FROM judged j JOIN ends e ON j.word = e.word
"""
