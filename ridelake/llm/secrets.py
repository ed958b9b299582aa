"""Secret scan with linking of credential parts (built-in expressions only).

Three base kinds are reported wherever they stand (assign, access, hex). Weaker
parts, which alone prove nothing, are reported only when complementary parts
stand within reach of each other: a login or key name (identifier) with a
secret, a random-looking string or loose assignment (secret) with an identifier
or access key, a service address (endpoint) with both.

Scale: one projection splits a text at each pattern's matches, behind cheap
substring guards; gap and match lengths of the few hits are written as a narrow
table, and their running sums give the code-point positions. The interval join
meets on (text, cell of twice the reach); matches of a kind don't overlap and
have a least length, so a cell holds a bounded number of parts and the join
grows with the hits. Texts are keyed by two hashes, so nulls and repeated rows
need no special path, and repeated rows are scanned for links once.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import free_names, read, written

REACH = 200      # code points between parts that belong together

# The base kinds' patterns (value: group 2), least lengths below.
_GLUE = r"""["']?\x20*[:=]\x20*["']?"""
ASSIGN = r"((?i:password|passwd|secret|token|api_?key))" + _GLUE + r"([A-Za-z0-9+/_.=-]+)"
ACCESS = r"(AKIA)([A-Z0-9]+)"
HEX = r"()([0-9a-f]+)"
# the parts that need company
IDENTIFIER = r"((?i:user_?name|user_?id|login|account_?id|client_?id|access_?key_?id|key_?id))" + _GLUE + r"([A-Za-z0-9@+/_.-]+)"
LOOSE = r"((?i:pass|pwd|auth_?key|private_?key|credentials?))" + _GLUE + r"([A-Za-z0-9+/_.=-]+)"
OPAQUE = r"()([A-Za-z0-9+/_=-]+)"
ENDPOINT = r"((?i:https?|ftps?|s3|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://)([A-Za-z0-9._:/@?=&%~+#-]+)"

KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
# (kind, role, pattern); role: which part of a credential a hit is
PATTERNS = (("assign", "secret", ASSIGN), ("access", "identifier", ACCESS), ("hex", "secret", HEX),
            ("identifier", "identifier", IDENTIFIER), ("secret", "secret", LOOSE), ("secret", "secret", OPAQUE),
            ("endpoint", "endpoint", ENDPOINT))


def _guard(k: int, text: Column, low: Column) -> Column:
    """A cheap condition that every text with a reportable hit of pattern ``k`` meets."""
    def has(col: Column, *parts: str) -> Column:
        out = F.lit(False)
        for p in parts:
            out = out | F.contains(col, F.lit(p))
        return out
    return (lambda: has(low, "password", "passwd", "secret", "token", "apikey", "api_key"),
            lambda: has(text, "AKIA"),
            lambda: text.rlike("[0-9a-f]{24}"),
            lambda: has(low, "user", "login", "account", "client", "key"),
            lambda: has(low, "pass", "pwd", "key", "credential"),
            lambda: text.rlike("[A-Za-z0-9+/_=-]{32}"),
            lambda: has(low, "://"))[k]()


def _counts(k: int, hit: Column, value: Column) -> Column:
    """Whether a match is a hit (the rest of the matches only take up their place)."""
    return (lambda: F.length(value) >= 6, lambda: F.length(hit) >= 20, lambda: F.length(hit) >= 24,
            lambda: F.length(value) >= 3, lambda: F.length(value) >= 6,
            lambda: (F.length(hit) >= 32) & hit.rlike("[0-9]") & hit.rlike("[a-z]") & hit.rlike("[A-Z]"),
            lambda: F.length(value) >= 4)[k]()


def _keys(id_col: str, text_col: str) -> tuple[Column, Column]:
    return F.xxhash64(F.col(id_col), F.col(text_col)), F.xxhash64(F.col(text_col), F.lit("secrets"))


def _matches(k: int, text: Column) -> Column:
    pattern = PATTERNS[k][2]
    zipped = F.arrays_zip(F.split(text, pattern).alias("p"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("h"),
                          F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).alias("v"))
    return F.transform(F.filter(zipped, lambda x: x["h"].isNotNull()), lambda x, i: F.struct(
        F.lit(k).alias("k"), i.alias("i"), F.length(x["p"]).alias("gap"), F.length(x["h"]).alias("n"), _counts(k, x["h"], x["v"]).alias("ok")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, k1, k2, found`` per row: found holds (pattern, place, gap, length, counts)
    of every match of the patterns whose guard the text meets, null if there is none."""
    k1, k2 = _keys(id_col, text_col)
    base = docs.select(F.col(id_col).alias("doc_id"), k1.alias("k1"), k2.alias("k2"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    base = base.withColumn("low", F.lower("t"))
    text, low = F.col("t"), F.col("low")
    guards = base.select("doc_id", "k1", "k2", "t", *[_guard(k, text, low).alias(f"g{k}") for k in range(len(PATTERNS))])
    # parts that need company are only looked for beside a part that they could go with
    secret, ident = F.col("g0") | F.col("g2") | F.col("g4") | F.col("g5"), F.col("g1") | F.col("g3")
    wanted = {k: F.col(f"g{k}") if k < 3 else F.col(f"g{k}") & secret & ident for k in range(len(PATTERNS))}
    lists = [F.when(wanted[k], _matches(k, text)).otherwise(F.array().cast("array<struct<k:int,i:int,gap:int,n:int,ok:boolean>>"))
             for k in range(len(PATTERNS))]
    found = F.concat(*lists)
    return guards.select("doc_id", "k1", "k2", F.when(F.size(found) > 0, found).alias("found"))


def parts(scanned: DataFrame) -> DataFrame:
    """``k1, k2, k, s, e``: each hit once per text, with code-point start and end."""
    rows = scanned.where("found is not null").select("k1", "k2", F.explode("found").alias("f")).select("k1", "k2", "f.*").distinct()
    upto = Window.partitionBy("k1", "k2", "k").orderBy("i")
    rows = rows.withColumn("e", F.sum(F.col("gap") + F.col("n")).over(upto))
    return rows.where("ok").select("k1", "k2", "k", (F.col("e") - F.col("n")).alias("s"), "e")


def _named(k: Column, what: int) -> Column:
    return F.element_at(F.array(*[F.lit(p[what]) for p in PATTERNS]), k + 1)


def linked(hits: DataFrame, reach: int = REACH) -> DataFrame:
    """The hits to report: all base hits, and the weak parts with the company they need
    (a weak secret that overlaps a base hit is that hit)."""
    cell = 2 * reach
    hits = hits.withColumn("role", _named(F.col("k"), 1))
    weak = hits.where(F.col("k") >= 3).withColumn("cell", F.explode(F.sequence(
        F.floor((F.col("s") - reach) / cell), F.floor((F.col("e") + reach) / cell))))
    other = hits.select("k1", "k2", F.col("k").alias("ok"), F.col("s").alias("os"), F.col("e").alias("oe"), F.col("role").alias("orole"),
                        F.explode(F.sequence(F.floor(F.col("s") / cell), F.floor(F.col("e") / cell))).alias("cell"))
    met = weak.join(other, ["k1", "k2", "cell"]).where((F.col("os") - F.col("e") <= reach) & (F.col("s") - F.col("oe") <= reach))
    covers = (F.col("ok") < 3) & (F.col("os") < F.col("e")) & (F.col("s") < F.col("oe"))
    apart = (F.col("os") >= F.col("e")) | (F.col("s") >= F.col("oe"))
    company = met.groupBy("k1", "k2", "k", "s", "e", "role").agg(
        F.max(covers).alias("covered"), F.max(apart & (F.col("orole") == "identifier")).alias("ident"),
        F.max(apart & (F.col("orole") == "secret")).alias("secret"))
    enough = F.when(F.col("role") == "identifier", F.col("secret")).when(F.col("role") == "secret", F.col("ident")).otherwise(
        F.col("secret") & F.col("ident"))
    kept = company.where(~F.col("covered") & enough).select("k1", "k2", "k", "s", "e")
    return hits.where(F.col("k") < 3).select("k1", "k2", "k", "s", "e").unionByName(kept)


def spans(reported: DataFrame) -> DataFrame:
    """``k1, k2, spans``: per text, (s, kind number, e) in order, without repeats."""
    kind = F.element_at(F.array(*[F.lit(KINDS.index(p[0])) for p in PATTERNS]), F.col("k") + 1)
    return reported.groupBy("k1", "k2").agg(F.sort_array(F.collect_set(F.struct(
        F.col("s").alias("s"), kind.alias("kind"), F.col("e").alias("e")))).alias("spans"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> tuple[DataFrame, DataFrame]:
    """The narrow scan of every row (doc_id, k1, k2) and the spans by text key, both written.

    Null or empty text: no span. Null id, repeated rows, equal texts: each row has the
    spans of its own text."""
    scanned = written(scan(docs, id_col, text_col), "secret-scan")
    return scanned.select("doc_id", "k1", "k2"), written(spans(linked(parts(scanned), reach)), "secret-spans")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", marker: str = "[SECRET]", reach: int = REACH) -> DataFrame:
    """``docs`` with every reported span of the text replaced by ``marker``, other columns and
    rows as they are."""
    _, found = find(docs, id_col, text_col, reach)
    a, b, c = free_names(docs, "k1", "k2", "spans")
    k1, k2 = _keys(id_col, text_col)
    rows = docs.withColumns({a: k1, b: k2}).join(found.select(F.col("k1").alias(a), F.col("k2").alias(b), F.col("spans").alias(c)), [a, b], "left")
    text = F.col(text_col)

    def step(acc: Column, x: Column) -> Column:
        gap = F.substring(text, acc["pos"] + 1, F.greatest(x["s"] - acc["pos"], F.lit(0)))
        return F.struct(F.concat(acc["out"], gap, F.when(x["e"] > acc["pos"], F.lit(marker)).otherwise("")).alias("out"),
                        F.greatest(acc["pos"], x["e"]).alias("pos"))

    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("pos"))
    clean = F.aggregate(F.col(c), start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["pos"] + 1, F.length(text))))
    return rows.withColumn(text_col, F.when(F.col(c).isNull(), text).otherwise(clean)).select(*[F.col(f"`{x}`") for x in docs.columns])


def _joined(items: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(items, lambda x: F.concat_ws(":", name[x["kind"]], x["s"], x["e"])), ",")


def op7_credential_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, found = find(read(spark, sf_dir, "documents").select("doc_id", "text"))
    all_spans = F.coalesce("spans", F.array().cast("array<struct<s:bigint,kind:int,e:bigint>>"))
    out = rows.join(found, ["k1", "k2"], "left").select("doc_id", all_spans.alias("x"))

    def n(kind: int) -> Column:
        return F.size(F.filter("x", lambda s: s["kind"] == kind)).cast("long")

    return out.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
                      F.sha2(_joined(F.filter("x", lambda s: s["kind"] < 3)), 256).alias("base_sha256"), _joined(F.col("x")).alias("spans"))


def _oracle() -> str:
    quoted = [p[2].replace("'", "''") for p in PATTERNS]
    ok = ["length(v) >= 6", "length(h) >= 20", "length(h) >= 24", "length(v) >= 3", "length(v) >= 6",
          "length(h) >= 32 AND regexp_matches(h, '[0-9]') AND regexp_matches(h, '[a-z]') AND regexp_matches(h, '[A-Z]')", "length(v) >= 4"]
    hits = " UNION ALL ".join(f"""
  SELECT doc_id, {k} AS k, '{PATTERNS[k][1]}' AS role, {KINDS.index(PATTERNS[k][0])} AS kind, e - length(h) AS s, e FROM (
    SELECT doc_id, h, v, sum(length(p) + length(h)) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM (
      SELECT doc_id, unnest(range(len(hs))) AS i, unnest(ps[1:len(hs)]) AS p, unnest(hs) AS h, unnest(vs) AS v FROM (
        SELECT doc_id, string_split_regex(t, '{q}') AS ps, regexp_extract_all(t, '{q}') AS hs, regexp_extract_all(t, '{q}', 2) AS vs FROM d)))
  WHERE {ok[k]}""" for k, q in enumerate(quoted))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
hits AS ({hits}),
company AS (
  SELECT a.doc_id, a.k, a.kind, a.role, a.s, a.e,
         bool_or(b.k < 3 AND b.s < a.e AND a.s < b.e) AS covered,
         bool_or((b.s >= a.e OR a.s >= b.e) AND b.role = 'identifier') AS ident,
         bool_or((b.s >= a.e OR a.s >= b.e) AND b.role = 'secret') AS secret
  FROM hits a JOIN hits b ON a.doc_id = b.doc_id AND b.s - a.e <= {REACH} AND a.s - b.e <= {REACH}
  WHERE a.k >= 3 GROUP BY ALL),
reported AS (
  SELECT DISTINCT doc_id, kind, s, e FROM hits WHERE k < 3
  UNION SELECT doc_id, kind, s, e FROM company WHERE NOT covered AND CASE role
    WHEN 'identifier' THEN secret WHEN 'secret' THEN ident ELSE secret AND ident END),
named AS (SELECT *, ['assign', 'access', 'hex', 'identifier', 'secret', 'endpoint'][kind + 1] || ':' || s::BIGINT || ':' || e::BIGINT AS x FROM reported),
texts AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
         coalesce(string_agg(x, ',' ORDER BY s, kind, e) FILTER (kind < 3), '') AS base, string_agg(x, ',' ORDER BY s, kind, e) AS spans
  FROM named GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN texts ON d.doc_id = texts.doc_id"""


OP7_SQL = _oracle()
