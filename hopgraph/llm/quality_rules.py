"""Operator 10: host-level quality rules with an empirical beta prior.

Every document is scored by rules with DataFrame functions alone.  The
failures of the soft rules are added up by host; each host's failure rate is
shrunk towards a beta prior fitted to all hosts by the method of moments, and
hosts whose shrunk rate lies over one prior deviation above the prior mean are
suspect.  The verdict joined back to the documents:

* ``base_failed``: under 50 words, or over half of the words in repeated
  three-word windows.  Never kept.
* otherwise a document is dropped when it fails a soft rule itself and its
  host is suspect; a document that fails no rule is always kept.

Cases: NULL or blank text has no words and fails the base; a NULL source is a
host of its own; repeated rows are judged alike and each counts; an empty
table gives an empty result; input columns may have any other names, since the
input row is carried as one struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hopgraph.llm.common import WHITE, table, words_of, written

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
SOFT_SYMBOLS_PCT = 10        # symbols in percent of the words
SOFT_DUP_LINES_PCT = 30      # repeated lines in percent of the lines with a word
SOFT_WORD_CHARS = (3, 12)    # mean word length
FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def _kept_chars(text: Column, drop: str) -> Column:
    return F.length(F.translate(text, drop, "")).cast("long")


def repeat_words(df: DataFrame, words: str, out: str) -> DataFrame:
    """Add ``out``: words inside three-word windows that the text holds twice or more.

    Each window becomes one long: the upper bits of its hash, then its
    position.  After a primitive sort equal windows are neighbours; a
    neighbour counts only if its words are equal too.
    """
    n = F.size(words)
    df = df.withColumn("_bits", F.length(F.bin(n)))
    at = lambda i: F.get(F.col(words), i)
    key = lambda w, i: F.call_function(
        "shiftleft", F.xxhash64(w, at(i + 1), at(i + 2)), F.col("_bits")).bitwiseOR(i.cast("long"))
    df = df.withColumn("_keys", F.sort_array(
        F.transform(F.slice(F.col(words), F.lit(1), F.greatest(n - 2, F.lit(0))), key)))
    df = df.withColumn("_mask", F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_bits")) - 1)
    high = lambda x: F.call_function("shiftrightunsigned", x, F.col("_bits"))
    start = lambda x: x.bitwiseAND(F.col("_mask")).cast("int")

    def same(x: Column, y: Column) -> Column:
        p, q = start(x), start(y)
        return ((high(x) == high(y)) & (at(p) == at(q)) & (at(p + 1) == at(q + 1))
                & (at(p + 2) == at(q + 2)))

    keys = F.col("_keys")
    repeated = F.filter(keys, lambda x, i: same(x, F.get(keys, i - 1)) | same(x, F.get(keys, i + 1)))
    covered = F.flatten(F.transform(repeated, lambda x: F.array(start(x), start(x) + 1, start(x) + 2)))
    return (df.withColumn(out, F.size(F.array_distinct(covered)).cast("long"))
            .drop("_bits", "_keys", "_mask"))


def rule_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` as one struct ``_row`` and, beside it, the rule features of ``text``."""
    df = docs.select(F.struct("*").alias("_row"))
    t = F.coalesce(F.col(f"_row.{text}"), F.lit(""))
    df = df.withColumn("_words", words_of(F.col(f"_row.{text}")))
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    df = repeat_words(df, "_words", "n_repeat_words").withColumn("_lines", lines)
    df = df.select(
        "_row", F.size("_words").cast("long").alias("n_words"),
        _kept_chars(t, WHITE).alias("word_chars"),
        (F.length(t) - _kept_chars(t, SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words")
    base = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    low, high = SOFT_WORD_CHARS
    soft = ((F.col("n_symbols") * 100 > F.col("n_words") * SOFT_SYMBOLS_PCT)
            | (F.col("n_dup_lines") * 100 > F.col("n_lines") * SOFT_DUP_LINES_PCT)
            | (F.col("word_chars") < F.col("n_words") * low) | (F.col("word_chars") > F.col("n_words") * high))
    return df.withColumn("base_failed", base).withColumn("rules_failed", base | soft)


def host_verdicts(hosts: DataFrame) -> DataFrame:
    """(``host``, ``n``, ``f``) to the same rows with ``rate`` (shrunk) and ``suspect``."""
    n, f = F.col("n").cast("double"), F.col("f").cast("double")
    total = hosts.agg(F.sum(n).alias("n"), F.sum(f).alias("f"), F.sum(f * f / n).alias("s"),
                      F.count("*").cast("double").alias("h"))
    mean = F.col("f") / F.col("n")
    spread = mean * (1 - mean)
    between = F.col("s") / F.col("n") - mean * mean - spread * F.col("h") / F.col("n")
    size = F.when(between > 0, F.greatest(F.lit(1.0), F.least(F.lit(1e6), spread / between - 1))).otherwise(1e6)
    prior = total.select(mean.alias("mean"), size.alias("size"), spread.alias("spread")).select(
        F.struct("mean", "size", F.sqrt(F.col("spread") / (F.col("size") + 1)).alias("dev")))
    df = hosts.withColumn("_p", prior.scalar())
    rate = (f + F.col("_p.mean") * F.col("_p.size")) / (n + F.col("_p.size"))
    return (df.withColumn("rate", rate)
            .withColumn("suspect", F.col("rate") > F.col("_p.mean") + F.col("_p.dev")).drop("_p"))


def judge(docs: DataFrame, host: str = "source", text: str = "text", carry_text: bool = True) -> DataFrame:
    """``_row`` struct, features, ``host_failed``/``host_docs``/``host_suspect`` and ``kept``.

    The text is read once: features and row (without the text unless
    ``carry_text``) are written to the shared folder, and both the host totals
    and the verdicts come from that table.  Host totals are a partial
    aggregate; the host table is joined by its measured size, and a host with
    a third of all rows is a skewed join that Spark splits.
    """
    scored = rule_features(docs, text)
    if not carry_text:
        scored = scored.withColumn("_row", F.col("_row").dropFields(text))
    scored = written(scored, "quality-rules")
    key = F.struct(F.col(f"_row.{host}").alias("h"))
    hosts = (scored.groupBy(key.alias("host"))
             .agg(F.count("*").alias("n"), F.sum(F.col("rules_failed").cast("long")).alias("f")))
    verdict = written(host_verdicts(written(hosts, "quality-hosts")), "quality-verdicts").select(
        F.col("host").alias("_host"), F.col("n").alias("host_docs"), F.col("f").alias("host_failed"),
        F.col("suspect").alias("host_suspect"))
    kept = ~F.col("base_failed") & ~(F.col("rules_failed") & F.col("host_suspect"))
    return (scored.withColumn("_key", key).join(verdict, F.col("_key").eqNullSafe(F.col("_host")), "left")
            .drop("_key", "_host").withColumn("kept", kept))


def quality_rules(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """The documents kept, with the columns of ``docs``."""
    return judge(docs, host, text).where("kept").select("_row.*")


def op10_quality_rules(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return judge(docs, carry_text=False).select(
        "_row.doc_id", "_row.source", *FEATURES, "rules_failed", "host_docs", "host_failed", "host_suspect", "kept")


SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (
  SELECT rid, i, ws[i] || chr(10) || ws[i+1] || chr(10) || ws[i+2] AS g
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (
  SELECT rid, count(DISTINCT p) AS n FROM (
    SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM (
      SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1) GROUP BY rid),
lin AS (
  SELECT rid, count(*) AS n, count(*) - count(DISTINCT x) AS d
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS x FROM w)
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY rid),
feat AS (
  SELECT w.rid, doc_id, source, len(ws)::BIGINT AS n_words,
         length(array_to_string(ws, ''))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         coalesce(lin.n, 0)::BIGINT AS n_lines, coalesce(lin.d, 0)::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep USING (rid) LEFT JOIN lin USING (rid)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM feat),
ruled AS (
  SELECT *, base_failed OR n_symbols * 100 > n_words * 10 OR n_dup_lines * 100 > n_lines * 30
            OR word_chars < n_words * 3 OR word_chars > n_words * 12 AS rules_failed FROM judged),
hosts AS (SELECT source, count(*)::DOUBLE AS n, sum(rules_failed::INT)::DOUBLE AS f FROM ruled GROUP BY source),
tot AS (SELECT sum(f) / sum(n) AS mean, sum(n) AS n, sum(f * f / n) AS s, count(*)::DOUBLE AS h FROM hosts),
btw AS (SELECT *, mean * (1 - mean) AS spread,
               s / n - mean * mean - mean * (1 - mean) * h / n AS between_var FROM tot),
prior AS (SELECT mean, spread, CASE WHEN between_var > 0
            THEN greatest(1.0, least(1e6, spread / between_var - 1)) ELSE 1e6 END AS size FROM btw),
verdict AS (
  SELECT source, hosts.n, f, (f + mean * size) / (hosts.n + size) > mean + sqrt(spread / (size + 1)) AS suspect
  FROM hosts, prior)
SELECT doc_id, r.source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, rules_failed,
       v.n::BIGINT AS host_docs, v.f::BIGINT AS host_failed, suspect AS host_suspect,
       NOT base_failed AND NOT (rules_failed AND suspect) AS kept
FROM ruled r JOIN verdict v ON r.source IS NOT DISTINCT FROM v.source
"""
