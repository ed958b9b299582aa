"""Host-level quality rules (built-in expressions only).

Every document is measured in one projection. The failures of its rules are
summed per host, each host's failure rate is shrunk towards the corpus rate by
a beta prior whose strength is estimated from the hosts themselves (method of
moments for beta-binomial counts), and the host's verdict is joined back.

Scale: measuring is a narrow projection (no shuffle, linear in the text: the
repeat rule sorts a text's window hashes instead of comparing them); hosts are
summed map-side first, so a host with a third of all rows sends one row per
task. The measures are written once and read twice (hosts, join); the host
table is written too, so its real size decides between a broadcast and a
sort-merge join whose hot host AQE splits. The prior is one row of four sums.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, free_names, read, words, written

# Fixed values of the base rule.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class HostRules:
    """``fail_symbols``/``fail_dup_lines``/``fail_word_chars``: limits of the document
    rules beside the base rule. A host is compared with the corpus: if the odds of its shrunk failure rate are
    ``block_lift`` times the corpus's or more, it loses all its documents, from ``watch_lift`` times on
    those that fail any rule. Either takes ``min_failures`` failures, and more than chance explains."""
    symbols_per_word: float = 0.2
    dup_lines: int = 10
    min_word_chars: float = 2.0
    max_word_chars: float = 15.0
    block_lift: float = 3.0
    watch_lift: float = 2.0
    min_failures: int = 5


Z2 = 3.8416              # squared normal quantile of 95 %


def measures(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the measures of each text and ``base_failed``; and the names that
    the new columns got (underscores are put in front of names already taken)."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = dict(zip(names, free_names(docs, *names)))
    ws, hs, ps, at = free_names(docs, "hq_words", "hq_hashes", "hq_pairs", "hq_at")
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, BLANKS, "") != "")
    long0 = F.lit(0).cast("long")
    # one projection per step, so that no array is computed more than once
    out = docs.withColumn(ws, words(F.col(text_col)))
    n = F.size(ws)
    w = F.col(ws)
    out = out.withColumn(hs, F.when(n >= 4, F.transform(
        F.slice(w, 1, n - 2), lambda x, i: F.xxhash64(x, w[i + 1], w[i + 2]))))
    h = F.col(hs)
    # only texts with a repeated window sort (hash, position)
    out = out.withColumn(ps, F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(
        F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    p = F.col(ps)
    out = out.withColumn(at, F.when(p.isNotNull(), F.sort_array(F.transform(F.filter(
        p, lambda x, i: (F.get(p, i - 1)["h"] == x["h"]) | (F.get(p, i + 1)["h"] == x["h"])), lambda x: x["i"]))))
    a = F.col(at)
    gaps = F.zip_with(a, F.slice(a, 2, F.greatest(F.size(a), F.lit(1))),
                      lambda x, y: F.least(F.coalesce(y - x, F.lit(3)), F.lit(3)))
    repeated = F.when(a.isNotNull(), F.aggregate(gaps, F.lit(0), lambda s, g: s + g).cast("long")).otherwise(long0)
    out = out.withColumns({
        got["n_words"]: n.cast("long"),
        got["word_chars"]: F.length(F.translate(text, BLANKS, "")).cast("long"),
        got["n_symbols"]: (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        got["n_dup_lines"]: (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        got["n_repeat_words"]: repeated,
    }).drop(ws, hs, ps, at)
    return out.withColumn(got["base_failed"], (F.col(got["n_words"]) < MIN_WORDS) | (
        100 * F.col(got["n_repeat_words"]) > MAX_REPEAT_PERCENT * F.col(got["n_words"]))), got


def _rule_failures(got: dict[str, str], rules: HostRules) -> Column:
    c = {k: F.col(v) for k, v in got.items()}
    return (c["base_failed"] | (c["n_symbols"] > rules.symbols_per_word * c["n_words"])
            | (c["n_dup_lines"] > rules.dup_lines) | (c["word_chars"] < rules.min_word_chars * c["n_words"])
            | (c["word_chars"] > rules.max_word_chars * c["n_words"]))


def host_verdicts(measured: DataFrame, host_col: str, failed: Column, rules: HostRules) -> DataFrame:
    """``host, docs, failures, rate, verdict`` (ok, watch, block) per host that is not null.

    With k of n documents failing, the shrunk rate is ``(k + s m) / (n + s)``: m is the
    corpus rate and s the prior's strength from the spread of the hosts' rates around m
    beyond what chance explains. No such spread (or one host): every host gets m."""
    hosts = written(measured.where(F.col(host_col).isNotNull()).groupBy(F.col(host_col).alias("host")).agg(
        F.count(F.lit(1)).alias("docs"), F.sum(F.when(failed, 1).otherwise(0)).alias("failures")), "host-counts")
    n, k = F.col("docs"), F.col("failures")
    # exact sums, so that the prior doesn't depend on the order of addition
    t = hosts.agg(F.count(F.lit(1)).alias("h"), F.sum(n).alias("n"), F.sum(k).alias("k"),
                  F.sum((n * n).cast("decimal(38,0)")).alias("nn"),
                  F.sum(F.round(k * k / n, 9).cast("decimal(38,9)")).alias("kkn")).first()
    if not t["h"]:
        return hosts.select("host", "docs", "failures", F.lit(0.0).alias("rate"), F.lit("ok").alias("verdict"))
    total, m = float(t["n"]), t["k"] / t["n"]
    spread = float(t["kkn"]) - t["k"] * m          # sum of n (k / n - m)^2
    freedom = total - float(t["nn"]) / total - (t["h"] - 1)
    between = (spread - m * (1 - m) * (t["h"] - 1)) / freedom if freedom > 0 else 0.0
    strength = max(m * (1 - m) / between - 1, 0.0) if between > 0 else None
    rate = F.lit(m) if strength is None else (k + F.lit(strength * m)) / (n + F.lit(strength))
    rate = F.round(rate, 9)
    more = k - n * F.lit(m)
    sure = (k >= rules.min_failures) & (more > 0) & (more * more > F.lit(Z2) * n * F.lit(m) * F.lit(1 - m))

    def lifted(times: float) -> Column:
        return sure & (rate * F.lit(1 - m) >= F.lit(times) * F.lit(m) * (F.lit(1.0) - rate))

    return hosts.select("host", "docs", "failures", rate.alias("rate"), F.when(
        lifted(rules.block_lift), "block").when(lifted(rules.watch_lift), "watch").otherwise("ok").alias("verdict"))


def judge(docs: DataFrame, text_col: str = "text", host_col: str = "source", rules: HostRules = HostRules(),
          keep_text: bool = True) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with measures, ``host_verdict`` and ``kept``; and the new columns' names.

    kept = not base_failed, and the host is ok, or on watch and the document fails no
    rule. Null or empty text: no words, so base_failed. Null host: belongs to no host,
    only its own base rule counts (host_verdict null). Repeated rows each count."""
    measured, got = measures(docs, text_col)
    verdict, kept, failed = free_names(measured, "host_verdict", "kept", "hq_failed")
    measured = measured.withColumn(failed, F.coalesce(_rule_failures(got, rules), F.lit(True)))
    if not keep_text:
        measured = measured.drop(text_col)
    measured = written(measured, "host-measures")
    hosts = written(host_verdicts(measured, host_col, F.col(failed), rules).select("host", "verdict"), "host-verdicts")
    host, v = free_names(measured, "hq_host", "hq_verdict")
    out = measured.join(hosts.select(F.col("host").alias(host), F.col("verdict").alias(v)),
                        F.col(host_col) == F.col(host), "left")
    out = out.withColumn(verdict, F.col(v)).withColumn(kept, ~F.col(got["base_failed"]) & (
        F.col(v).isNull() | (F.col(v) == "ok") | ((F.col(v) == "watch") & ~F.col(failed)))).drop(host, v, failed)
    return out, got | {"host_verdict": verdict, "kept": kept}


def op1_host_quality_rules(spark, sf_dir: str) -> DataFrame:
    out, _ = judge(read(spark, sf_dir, "documents").select("doc_id", "text", "source"), keep_text=False)
    return out.drop("source")


OP1_SQL = r"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
pos AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM w),
win AS (SELECT doc_id, i, word, lead(word, 1) OVER d AS w1, lead(word, 2) OVER d AS w2 FROM pos
        WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, word, w1, w2) AS c
        FROM win WHERE w2 IS NOT NULL) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (VALUES (0), (1), (2)) t(k) GROUP BY doc_id),
base AS (
  SELECT w.doc_id, source, len(ws)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN cov ON w.doc_id = cov.doc_id),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base),
rules AS (SELECT *, (base_failed OR n_symbols > 0.2 * n_words OR n_dup_lines > 10
                     OR word_chars < 2.0 * n_words OR word_chars > 15.0 * n_words) AS failed FROM judged),
hosts AS (SELECT source, count(*)::DOUBLE AS n, count(*) FILTER (failed)::DOUBLE AS k
          FROM rules WHERE source IS NOT NULL GROUP BY source),
corpus AS (SELECT count(*) AS h, sum(n) AS n, sum(k) / sum(n) AS m, sum(n * n) AS nn,
                  sum(round(k * k / n, 9)::DECIMAL(38, 9))::DOUBLE - sum(k) * (sum(k) / sum(n)) AS s FROM hosts),
spread AS (SELECT (s - m * (1 - m) * (h - 1)) / (n - nn / n - (h - 1)) AS b, m FROM corpus),
shrunk AS (SELECT source, n, k, m, round(CASE WHEN b > 0 THEN (k + greatest(m * (1 - m) / b - 1, 0) * m)
                                                          / (hosts.n + greatest(m * (1 - m) / b - 1, 0)) ELSE m END, 9) AS rate
           FROM hosts, spread),
sure AS (SELECT *, k >= 5 AND k - n * m > 0 AND (k - n * m) * (k - n * m) > 3.8416::DOUBLE * n * m * (1 - m) AS sure FROM shrunk),
verdicts AS (SELECT source, CASE WHEN sure AND rate * (1 - m) >= 3 * m * (1 - rate) THEN 'block'
                                 WHEN sure AND rate * (1 - m) >= 2 * m * (1 - rate) THEN 'watch' ELSE 'ok' END AS v FROM sure)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, v AS host_verdict,
       NOT base_failed AND (v IS NULL OR v = 'ok' OR (v = 'watch' AND NOT failed)) AS kept
FROM rules LEFT JOIN verdicts ON rules.source = verdicts.source
"""
