"""Personal data by weak supervision (built-in expressions only).

Four base kinds are reported wherever they stand (email, ip, card, phone). Further candidates (spelled-out
mail addresses, long ip addresses, national phone numbers, card-like numbers with a wrong check
digit, names after a title or a known given name) are judged: ``VOTES`` labelers (shape, check digit, gazetteer,
words of context for and against, borders, repetition) vote on each candidate or abstain. Expectation
maximisation over the counts of vote patterns estimates, for every kind, how reliable each labeler is and how likely a
pattern is personal data. These soft labels of all candidates train the final span classifier, a naive
Bayes over features of the span and its surroundings. A candidate is added if the
classifier says so, some labeler of the first four spoke for it (beside a wrong check digit: the words of
context), and it overlaps no base span.

Scale: one projection splits a text at each pattern's matches, behind cheap conditions; what is written are the
few hits, with a short context, never texts. Running sums of gap and match lengths give code-point
positions. Pattern counts, reliabilities and classifier have a size fixed by the number of kinds, labelers
and features (``kinds x 3^VOTES`` patterns at most), whatever the corpus; everything is counted over all documents.

Null or empty text: no span. Null id, repeated rows: each row has the spans of its own text; rows equal in id
and text count once for the classifier. No pattern needs more than linear time on long texts.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import read, written

KINDS = ("email", "ip", "card", "phone", "name")

# The base kinds' patterns.
BASE = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
# The same matches in linear time: no run of characters is tried from its middle, nothing is given back. The
# third takes chains of 12 digits or more (shorter ones fail anyway, from wherever they are tried).
LINEAR = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
          r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9](?:[ -]?[0-9]){11,}+", r"\+[0-9][\x20().0-9-]+[0-9]")
TITLES = "Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Madame|Monsieur|Mme|Señor|Señora|Sra"
GIVEN = ("Anna|Maria|John|James|Robert|Michael|William|David|Mary|Patricia|Jennifer|Linda|Elizabeth|Susan|Peter|Paul|Thomas|Daniel|Sarah|Laura|"
         "Hans|Klaus|Jürgen|Ursula|Sabine|Stefan|Andreas|Pierre|Jean|Marie|Sophie|Camille|Luc|Juan|José|Carlos|Carmen|Pedro|Luis|Sofía")
WEAK = (r"[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63}(?: ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]{1,63}){1,8}",
        r"[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}",
        r"[(]?[0-9]{2,5}[)]?(?:[ /-][0-9]{2,5}){2,4}",
        rf"(?:{TITLES}|{GIVEN})[.]? [A-ZÀ-Þ][a-zß-ÿ]{{1,30}}(?: [A-ZÀ-Þ][a-zß-ÿ]{{1,30}})?")
PATTERNS = LINEAR + WEAK
KIND_OF = (0, 1, 2, 3, 0, 1, 3, 4)
# A condition that every text with a reportable hit meets; ``t`` is the text.
GUARDS = ("contains(t, '@')", "regexp_like(t, '[0-9][.][0-9]')", "regexp_like(t, '[0-9](?:[ -]?[0-9]){11}')", "contains(t, '+')",
          "contains(t, '(at)') OR contains(t, '[at]') OR (contains(t, ' at ') AND contains(t, 'dot'))", "regexp_like(t, ':[0-9A-Fa-f]{1,4}:[0-9A-Fa-f]{1,4}:')",
          "regexp_like(t, '[0-9][)]?[ /-][0-9]{2,5}[ /-][0-9][0-9]')", f"regexp_like(t, '(?=[A-Z])(?:{TITLES}|{GIVEN})[.]? [A-ZÀ-Þ]')")
AROUND = 32          # code points before a hit that labelers see
ROUNDS = 10          # of expectation maximisation
HOLD = 50.0          # how many observations the initial reliabilities weigh

# Conditions and votes are SQL that holds for each engine: {like} regular-expression test, {luhn} check digit of ``d``.
# h: the match, d: its digits, b: lower-case text before, a: text after, k: pattern, n: length of the match.
IS_BASE = ("CASE k WHEN 0 THEN true WHEN 1 THEN {like}(h, '^0*([0-9]{{1,2}}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])([.]0*([0-9]{{1,2}}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])){{3}}$')"
           " WHEN 2 THEN length(d) BETWEEN 12 AND 19 AND luhn WHEN 3 THEN length(d) BETWEEN 9 AND 15 ELSE false END")
IS_CANDIDATE = "base OR k > 3 OR (k = 2 AND length(d) BETWEEN 12 AND 19)"
# 0 against, 1 abstains, 2 for
LABELERS = (
    # shape
    "CASE k WHEN 0 THEN CASE WHEN {like}(h, '^[A-Za-z0-9].*[.][A-Za-z]{{2,24}}$') THEN 2 ELSE 0 END"
    " WHEN 1 THEN CASE WHEN {like}(h, '(^|[.])0[0-9]') THEN 0 ELSE 2 END"
    " WHEN 2 THEN CASE WHEN {like}(h, '^[0-9]{{13,19}}$|^([0-9]{{4}}[ -]){{3,4}}[0-9]{{1,4}}$') THEN 2 ELSE 0 END"
    " WHEN 3 THEN CASE WHEN {like}(h, '^[+][0-9]{{1,3}}[ .-]?[(]?[0-9]{{2,4}}[)]?([ .-]?[0-9]{{2,4}}){{1,4}}$') THEN 2 ELSE 1 END"
    " WHEN 4 THEN CASE WHEN contains(h, '(at)') OR contains(h, '[at]') THEN 2 ELSE 1 END WHEN 5 THEN 2"
    " WHEN 6 THEN CASE WHEN {like}(h, '^(19|20)[0-9][0-9][ /-]|[ /-](19|20)[0-9][0-9]$') THEN 0"
    " WHEN {like}(h, '^[(]?[0-9]{{3}}[)]?[ -][0-9]{{3}}[ -][0-9]{{4}}$|^[(]?0[1-9][0-9]{{0,3}}[)]?[ /-]') THEN 2 ELSE 1 END"
    " ELSE CASE WHEN {like}(h, ' [^ ]+ [^ ]+$') THEN 2 ELSE 1 END END",
    # check digit, or numbers that can't be
    "CASE k WHEN 0 THEN CASE WHEN {like}(h, '^[^@]*[A-Za-z]') THEN 2 ELSE 1 END WHEN 1 THEN CASE WHEN {like}(h, '^(0|127|255)[.]') THEN 0 ELSE 1 END"
    " WHEN 2 THEN CASE WHEN luhn THEN 2 ELSE 0 END WHEN 3 THEN CASE WHEN {like}(h, '^[+]0') THEN 0 ELSE 1 END"
    " WHEN 6 THEN CASE WHEN length(d) BETWEEN 9 AND 12 THEN 1 ELSE 0 END ELSE 1 END",
    # gazetteer: top-level domains, issuers, calling codes, given names
    "CASE k WHEN 0 THEN CASE WHEN {like}(h, '[.](com|org|net|edu|gov|info|io|eu|us|uk|de|fr|es|it|at|ch|nl)$') THEN 2 ELSE 1 END"
    " WHEN 4 THEN CASE WHEN {like}(h, '(com|org|net|edu|gov|info|io|eu|us|uk|de|fr|es|it|at|ch|nl)$') THEN 2 ELSE 0 END"
    " WHEN 2 THEN CASE WHEN {like}(d, '^(4|5[1-5]|2[2-7]|3[47]|6011|65|35)') THEN 2 ELSE 0 END"
    " WHEN 3 THEN CASE WHEN {like}(h, '^[+](1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])') THEN 2 ELSE 1 END"
    f" WHEN 7 THEN CASE WHEN {{like}}(h, '^({GIVEN}) ') THEN 2 ELSE 1 END ELSE 1 END",
    # words before that speak for the kind
    "CASE WHEN (k IN (0, 4) AND {like}(b, 'mail|contact|kontakt|correo|courriel')) OR (k IN (1, 5) AND {like}(b, '(^|[^a-z])(ip|host|address|server|client|from)([^a-z]|$)'))"
    " OR (k = 2 AND {like}(b, 'card|karte|tarjeta|carte|visa|credit|kredit')) OR (k IN (3, 6) AND {like}(b, 'phone|(^|[^a-z])(tel|call|fax|mobile|mobil|handy|cell)([^a-z]|$)'))"
    " OR (k = 7 AND {like}(b, 'name|signed|sincerely|regards|author|patient|dear|liebe|chère|estimad')) THEN 2 ELSE 1 END",
    # words before that speak against any
    "CASE WHEN {like}(b, '(version|release|isbn|issn|order|invoice|article|section|ticket|serial|build|price|total|page|room|line|figure|chapter|id)[^a-z]{{0,4}}$') THEN 0 ELSE 1 END",
    # borders
    "CASE WHEN {like}(right(b, 1), '[a-z0-9_/=]') OR {like}(a, '^[A-Za-z0-9_]') THEN 0 ELSE 1 END",
    # digits that repeat or count up
    "CASE WHEN k IN (1, 2, 3, 6) AND ({like}(d, '^(0+|1+|2+|3+|4+|5+|6+|7+|8+|9+)$') OR contains(d, '123456') OR contains(d, '000000')) THEN 0 ELSE 1 END",
)
VOTES = len(LABELERS)
# 2 if a labeler spoke for a candidate; against a wrong check digit only words of context can
SPOKEN = "CASE WHEN v1 = 0 THEN v3 ELSE greatest(v0, v1, v2, v3) END"
# Initial probability of a vote (against, abstains, for) on personal data, and on anything else: the check digit is trusted most.
START = [((0.02, 0.4, 0.58), (0.68, 0.3, 0.02)) if j == 1 else ((0.1, 0.4, 0.5), (0.5, 0.4, 0.1)) for j in range(VOTES)]
_SIGN = "CASE WHEN {c} = '' THEN 0 WHEN {like}({c}, '^[A-Za-z]') THEN 1 WHEN {like}({c}, '^[0-9]') THEN 2 WHEN {like}({c}, '^[ \t\n]') THEN 3 ELSE 4 END"
# features of a span, each a small whole number; q is the likelihood of its vote pattern
FEATURES = ("k", "least(n, 40)", "least(length(d), 20)", _SIGN.replace("{c}", "right(b, 1)"), _SIGN.replace("{c}", "left(a, 1)"),
            "least(n - length(d), 12)", "v3 * 3 + v4", "CAST(floor(q * 10) AS INT)")

# log odds of a feature's value (p, o: soft counts on personal data and on anything else; ps, os: of all values). Both
# are drawn to the value's share of all candidates, so a value or class that was seldom seen says little.
SMOOTH = 5.0
_SHARE = f"{SMOOTH} * (p + o) / (ps + os)"
ODDS = f"ln((p + {_SHARE}) / (ps + {SMOOTH})) - ln((o + {_SHARE}) / (os + {SMOOTH}))"

SPARK = {"like": "regexp_like"}
SPARK_DIGITS = "regexp_replace(h, '[^0-9]', '')"
SPARK_LUHN = ("aggregate(transform(split(reverse(d), ''), (x, i) -> CAST(x AS INT) * (1 + i % 2)), 0, (acc, v) -> acc + v - CASE WHEN v > 9 THEN 9 ELSE 0 END) % 10 = 0")


def _keys(id_col: str, text_col: str) -> tuple[Column, Column]:
    return F.xxhash64(F.col(id_col), F.col(text_col)), F.xxhash64(F.col(text_col), F.lit("personal"))


def _matches(k: int) -> Column:
    """Each match of pattern ``k``: place, length of the gap before it, match, text before and after."""
    p = PATTERNS[k]
    gaps, hits = F.split("t", p), F.regexp_extract_all("t", F.lit(p), F.lit(0))
    return F.transform(F.filter(F.arrays_zip(gaps.alias("p"), hits.alias("h"), F.slice(gaps, 2, 2**31 - 1).alias("q")), lambda x: x["h"].isNotNull()),
                       lambda x, i: F.struct(F.lit(k).alias("k"), i.alias("i"), F.length(x["p"]).alias("gap"), x["h"].alias("h"),
                                             F.lower(F.right(x["p"], F.lit(AROUND))).alias("b"), F.left(x["q"], F.lit(1)).alias("a")))


FOUND = "array<struct<k:int,i:int,gap:int,h:string,b:string,a:string>>"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, k1, k2, found`` per row; found is null if no pattern's condition is met."""
    k1, k2 = _keys(id_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), k1.alias("k1"), k2.alias("k2"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    found = F.concat(*[F.when(F.expr(GUARDS[k]), _matches(k).cast(FOUND)).otherwise(F.array().cast(FOUND)) for k in range(len(PATTERNS))])
    return rows.select("doc_id", "k1", "k2", found.alias("found")).withColumn("found", F.expr("CASE WHEN size(found) > 0 THEN found END"))


def candidates(scanned: DataFrame) -> DataFrame:
    """``k1, k2, k, kind, base, s, e, n, h, b, a, d, v0..``: every candidate once per text, with code-point start and
    end and the labelers' votes."""
    rows = scanned.where("found is not null").select("k1", "k2", F.explode("found").alias("f")).select("k1", "k2", "f.*").distinct()
    upto = Window.partitionBy("k1", "k2", "k").orderBy("i")
    rows = rows.withColumns({"n": F.length("h"), "a": F.coalesce("a", F.lit("")), "d": F.expr(SPARK_DIGITS)})
    rows = rows.withColumn("e", F.sum(F.col("gap") + F.col("n")).over(upto)).withColumn("s", F.col("e") - F.col("n"))
    rows = rows.withColumn("luhn", F.expr(f"CASE WHEN k = 2 AND length(d) < 20 THEN {SPARK_LUHN} ELSE false END"))
    rows = rows.withColumn("base", F.expr(IS_BASE.format(**SPARK))).where(IS_CANDIDATE)
    kind = F.element_at(F.array(*[F.lit(x) for x in KIND_OF]), F.col("k") + 1)
    return rows.withColumn("kind", kind).withColumns({f"v{j}": F.expr(v.format(**SPARK)) for j, v in enumerate(LABELERS)})


def _votes() -> Column:
    return F.array(*[F.col(f"v{j}") for j in range(VOTES)])


def likelihoods(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``kind, votes, q``: how likely each vote pattern of a kind is personal data, by expectation maximisation over
    the patterns' counts (their number is bounded, one row per kind holds them)."""
    counts = found.groupBy("kind", _votes().alias("votes")).agg(F.count(F.lit(1)).alias("n"))
    kinds = counts.groupBy("kind").agg(F.array_sort(F.collect_list(F.struct("votes", F.col("n").cast("double").alias("n")))).alias("seen"))

    def rates(side: int) -> Column:
        return F.array(*[F.array(*[F.lit(x) for x in START[j][side]]) for j in range(VOTES)])

    def share(state: Column, votes: Column) -> Column:
        def log(side: str) -> Column:
            return F.aggregate(F.sequence(F.lit(0), F.lit(VOTES - 1)), F.lit(0.0), lambda acc, j: acc + F.log(state[side][j][votes[j]]))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.log((F.lit(1.0) - state["prior"]) / state["prior"]) + log("other") - log("personal")))

    def step(state: Column, _: Column) -> Column:
        weighed = F.transform("seen", lambda p: F.struct(p["votes"].alias("votes"), (p["n"] * share(state, p["votes"])).alias("x"), p["n"].alias("n")))

        def again(w: Column) -> Column:
            def side(of, start: int) -> Column:
                total = F.aggregate(w, F.lit(0.0), lambda acc, p: acc + of(p)) + HOLD
                first = rates(start)
                return F.transform(F.sequence(F.lit(0), F.lit(VOTES - 1)), lambda j: F.transform(F.sequence(F.lit(0), F.lit(2)), lambda v: (
                    F.aggregate(w, F.lit(0.0), lambda acc, p: acc + F.when(p["votes"][j] == v, of(p)).otherwise(0.0)) + first[j][v] * HOLD) / total))
            x, n = F.aggregate(w, F.lit(0.0), lambda acc, p: acc + p["x"]), F.aggregate(w, F.lit(0.0), lambda acc, p: acc + p["n"])
            return F.struct(((x + HOLD / 2) / (n + HOLD)).alias("prior"), side(lambda p: p["x"], 0).alias("personal"),
                            side(lambda p: p["n"] - p["x"], 1).alias("other"))
        return F.transform(F.array(weighed), again)[0]      # names the weighed patterns, so that they are computed once

    start = F.struct(F.lit(0.5).alias("prior"), rates(0).alias("personal"), rates(1).alias("other"))
    fitted = kinds.select("kind", "seen", F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step).alias("state"))
    return fitted.select("kind", F.explode(F.transform("seen", lambda p: F.struct(p["votes"].alias("votes"), share(F.col("state"), p["votes"]).alias("q")))).alias("p")
                         ).select("kind", "p.votes", "p.q")


def judged(found: DataFrame, q: DataFrame) -> DataFrame:
    """The candidates with the classifier's ``score`` (log odds): naive Bayes on the soft labels of all candidates."""
    rows = found.join(q, (found["kind"] == q["kind"]) & (_votes() == q["votes"])).drop(q["kind"]).drop("votes")
    x = F.array(*[F.expr(f.format(**SPARK)).cast("int") for f in FEATURES])
    rows = written(rows.select("k1", "k2", "k", "kind", "base", "s", "e", "q", F.expr(SPOKEN).alias("best"), x.alias("x")), "pii-labelled")
    each = rows.select("kind", "q", F.posexplode("x").alias("f", "v")).groupBy("kind", "f", "v").agg(
        F.sum("q").alias("p"), F.sum(F.lit(1.0) - F.col("q")).alias("o"))
    whole = Window.partitionBy("kind", "f")
    each = each.withColumns({"ps": F.sum("p").over(whole), "os": F.sum("o").over(whole)})
    odds = each.select("kind", "f", "v", F.expr(ODDS).alias("w"))
    prior = rows.groupBy("kind").agg(F.log((F.sum("q") + 1) / (F.sum(F.lit(1.0) - F.col("q")) + 1)).alias("prior"))
    model = odds.groupBy("kind").agg(F.map_from_entries(F.collect_list(F.struct(F.struct("f", "v"), "w"))).alias("model")).join(prior, "kind")
    score = F.aggregate(F.transform("x", lambda v, i: F.col("model")[F.struct(i.alias("f"), v.alias("v"))]), F.col("prior"), lambda acc, w: acc + w)
    return rows.join(model, "kind").select("k1", "k2", "k", "kind", "base", "s", "e", "q", "best", score.alias("score"))


def reported(rows: DataFrame) -> DataFrame:
    """All base spans, and the candidates that the classifier takes and that overlap none of them."""
    rows = rows.where(F.col("base") | ((F.col("score") > 0) & (F.col("q") >= 0.5) & (F.col("best") == 2)))
    text = Window.partitionBy("k1", "k2").orderBy("s")
    before = F.max(F.when(F.col("base"), F.col("e"))).over(text.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.min(F.when(F.col("base"), F.col("s"))).over(text.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    rows = rows.withColumns({"before": before, "after": after})
    clear = (F.coalesce(F.col("before") <= F.col("s"), F.lit(True))) & F.coalesce(F.col("after") >= F.col("e"), F.lit(True))
    return rows.where(F.col("base") | clear).select("k1", "k2", "kind", "base", "s", "e")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The rows (``doc_id, k1, k2``) and, by text key, ``spans``: (s, kind, e, base) in order."""
    scanned = written(scan(docs, id_col, text_col), "pii-scan")
    found = written(candidates(scanned), "pii-candidates")
    spans = reported(judged(found, written(likelihoods(found), "pii-likelihoods"))).groupBy("k1", "k2").agg(
        F.sort_array(F.collect_set(F.struct("s", "kind", "e", "base"))).alias("spans"))
    return scanned.select("doc_id", "k1", "k2"), written(spans, "pii-spans")


def _joined(items: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(items, lambda x: F.concat_ws(":", name[x["kind"]], x["s"], x["e"])), ",")


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, found = find(read(spark, sf_dir, "documents").select("doc_id", "text"))
    none = F.array().cast("array<struct<s:bigint,kind:int,e:bigint,base:boolean>>")
    out = rows.join(found, ["k1", "k2"], "left").select("doc_id", F.coalesce("spans", none).alias("x"))

    def n(kind: int) -> Column:
        return F.size(F.filter("x", lambda s: s["base"] & (s["kind"] == kind))).cast("long")

    return out.select("doc_id", *[n(i).alias(f"n_{KINDS[i]}") for i in range(4)],
                      F.sha2(_joined(F.filter("x", lambda s: s["base"])), 256).alias("base_sha256"), _joined(F.col("x")).alias("spans"))


def _oracle() -> str:
    duck = {"like": "regexp_matches"}
    patterns = (*BASE[:2], PATTERNS[2].replace("}+", "}"), BASE[3], *WEAK)
    hits = " UNION ALL ".join(f"""
  SELECT doc_id, {k} AS k, i, h, lower(right(p, {AROUND})) AS b, left(coalesce(q, ''), 1) AS a, sum(length(p) + length(h)) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM (
    SELECT doc_id, unnest(range(len(hs))) AS i, unnest(ps[1:len(hs)]) AS p, unnest(hs) AS h, unnest(ps[2:len(hs) + 1]) AS q FROM (
      SELECT doc_id, string_split_regex(t, '{pattern}') AS ps, regexp_extract_all(t, '{pattern}') AS hs FROM docs))""" for k, pattern in enumerate(patterns))
    luhn = "list_sum(list_transform(string_split(reverse(d), ''), lambda x, i: CASE WHEN i % 2 = 0 THEN 2 * x::INT - CASE WHEN x::INT > 4 THEN 9 ELSE 0 END ELSE x::INT END)) % 10 = 0"
    votes = ", ".join(f"{v.format(**duck)} AS v{j}" for j, v in enumerate(LABELERS))
    features = ", ".join(f"({f.format(**duck)})::INT" for f in FEATURES)
    start = ", ".join(f"({j}, {v}, {START[j][0][v]}::DOUBLE, {START[j][1][v]}::DOUBLE)" for j in range(VOTES) for v in range(3))
    cast = ", ".join(f"({j}, v{j})" for j in range(VOTES))
    steps = ["r0 AS (SELECT kind, j, v, p0 AS p, o0 AS o FROM (SELECT DISTINCT kind FROM seen), start), "
             "pr0 AS (SELECT DISTINCT kind, 0.5::DOUBLE AS prior FROM seen)"]
    for i in range(ROUNDS + 1):
        steps.append(f"""q{i} AS MATERIALIZED (SELECT c.kind, c.pat, any_value(c.n) AS n, 1 / (1 + exp(ln((1 - any_value(prior)) / any_value(prior)) + sum(ln(o)) - sum(ln(p)))) AS q
  FROM cast_votes c JOIN r{i} r USING (kind, j, v) JOIN pr{i} USING (kind) GROUP BY c.kind, c.pat)""")
        if i < ROUNDS:
            steps.append(f"""pr{i + 1} AS MATERIALIZED (SELECT kind, (sum(n * q) + {HOLD / 2}) / (sum(n) + {HOLD}) AS prior, sum(n * q) + {HOLD} AS ps, sum(n * (1 - q)) + {HOLD} AS os FROM q{i} GROUP BY kind),
r{i + 1} AS MATERIALIZED (SELECT r.kind, r.j, r.v, (coalesce(sum(q.n * q.q), 0) + any_value(s.p0) * {HOLD}) / any_value(ps) AS p,
    (coalesce(sum(q.n * (1 - q.q)), 0) + any_value(s.o0) * {HOLD}) / any_value(os) AS o
  FROM r{i} r JOIN start s USING (j, v) JOIN pr{i + 1} USING (kind) LEFT JOIN cast_votes c ON c.kind = r.kind AND c.j = r.j AND c.v = r.v
  LEFT JOIN q{i} q ON q.kind = c.kind AND q.pat = c.pat GROUP BY r.kind, r.j, r.v)""")
    names = "[" + ", ".join(f"'{k}'" for k in KINDS) + "]"
    counts = ", ".join(f"count(*) FILTER (base AND kind = {i}) AS n_{KINDS[i]}" for i in range(4))
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
hits AS ({hits}),
digits AS (SELECT *, e - length(h) AS s, length(h) AS n, regexp_replace(h, '[^0-9]', '', 'g') AS d FROM hits),
checked AS (SELECT *, CASE WHEN k = 2 AND length(d) < 20 THEN {luhn} ELSE false END AS luhn FROM digits),
based AS (SELECT *, {IS_BASE.format(**duck)} AS base, {list(KIND_OF)}[k + 1] AS kind FROM checked),
voted AS (SELECT *, {votes} FROM based WHERE {IS_CANDIDATE}),
patterned AS (SELECT *, concat_ws(',', {', '.join(f'v{j}' for j in range(VOTES))}) AS pat FROM voted),
seen AS MATERIALIZED (SELECT kind, pat, count(*)::DOUBLE AS n, {', '.join(f'any_value(v{j}) AS v{j}' for j in range(VOTES))} FROM patterned GROUP BY kind, pat),
start AS MATERIALIZED (SELECT * FROM (VALUES {start}) AS x(j, v, p0, o0)),
cast_votes AS MATERIALIZED (SELECT kind, pat, n, x.j, x.v FROM seen, LATERAL (SELECT unnest(range({VOTES})) AS j, unnest([{', '.join(f'v{j}' for j in range(VOTES))}]) AS v) x),
{', '.join(steps)},
labelled AS (SELECT p.*, q.q, [{features}] AS x FROM patterned p JOIN (SELECT kind, pat, q FROM q{ROUNDS}) q USING (kind, pat)),
each AS (SELECT kind, f, v, sum(q) AS p, sum(1 - q) AS o FROM (SELECT kind, q, unnest(range(len(x))) AS f, unnest(x) AS v FROM labelled) GROUP BY ALL),
totals AS (SELECT *, sum(p) OVER w AS ps, sum(o) OVER w AS os FROM each WINDOW w AS (PARTITION BY kind, f)),
odds AS (SELECT kind, f, v, {ODDS} AS w FROM totals),
prior AS (SELECT kind, ln((sum(q) + 1) / (sum(1 - q) + 1)) AS prior FROM labelled GROUP BY kind),
numbered AS (SELECT *, row_number() OVER () AS r FROM labelled),
scores AS (SELECT r, sum(w) AS w FROM (SELECT r, kind, unnest(range(len(x))) AS f, unnest(x) AS v FROM numbered) JOIN odds USING (kind, f, v) GROUP BY r),
taken AS (SELECT n.* FROM numbered n JOIN scores USING (r) JOIN prior USING (kind)
  WHERE base OR (scores.w + prior > 0 AND q >= 0.5 AND {SPOKEN} = 2)),
clear AS (SELECT * FROM taken a WHERE base OR NOT EXISTS (SELECT 1 FROM taken b WHERE b.base AND b.doc_id = a.doc_id AND b.s < a.e AND a.s < b.e)),
named AS (SELECT DISTINCT doc_id, kind, s, e, base, {names}[kind + 1] || ':' || s::BIGINT || ':' || e::BIGINT AS x FROM clear),
texts AS (SELECT doc_id, {counts}, coalesce(string_agg(x, ',' ORDER BY s, kind, e) FILTER (base), '') AS base, string_agg(x, ',' ORDER BY s, kind, e) AS spans FROM named GROUP BY doc_id)
SELECT d.doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in KINDS[:4])}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs d LEFT JOIN texts ON d.doc_id = texts.doc_id"""


OP11_SQL = _oracle()
