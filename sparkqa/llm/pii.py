"""Personal data: overlapping candidates, boosted trees over format and context, calibrated thresholds.

Base patterns with their checks give spans that always stay.  High-recall generators propose more
(numbers without a plus, bare ones too, dotted cards, bracketed and spelled-out addresses, colon hex groups, whole and
shortened); gradient-boosted
trees score each from its format and the text around it, and those over the threshold of their kind
are added.  Texts are scanned whole by Spark's own functions; there is no Python on the path.

Edge cases: a null text is empty; rows are told apart by their place, so null or repeated ids keep
one result row each; a text without candidates gets zero counts and an empty span list; an empty
table gives an empty result; other columns are not read, so their names cannot clash.  Offsets are
code points, the end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkqa.llm.common import materialize

# The base patterns.  Runs are possessive and start only at their first character (or
# right after the last match), which finds the same leftmost matches in linear time and without
# deep recursion on long runs.
KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"[A-Za-z0-9._%+-]{1,64}\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]{2,63}){1,4}"
             r"|(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20at\x20[A-Za-z0-9-]{1,63}(?:\x20dot\x20[A-Za-z0-9-]{2,63}){1,4}",
    "ip": r"(?<![0-9A-Za-z:])(?:(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:])",
    "card": r"(?<![0-9A-Za-z])[0-9]{4}(?:[./_][0-9]{2,6}){2,4}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+])(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[\x20./-][0-9]{2,4}){2,4}(?![0-9A-Za-z])|(?<![0-9A-Za-z+.,:/_-])[0-9]{7,11}(?![0-9A-Za-z_/]|[.,:-][0-9])",
}
CUES = {
    "email": r"(?i)(?:e-?mail|contact|write|reach|address)",
    "ip": r"(?i)(?:\bip|address|host|server|client|login)",
    "card": r"(?i)(?:card|visa|credit|debit|payment|account)",
    "phone": r"(?i)(?:phone|\b(?:tel|call|mobile|fax|dial|cell)\b)",
}
AGAINST = r"(?i)(?:order|invoice|version|isbn|issue|page|date|ref|serial|build|item|code|\bno\b|\bid\b)"
WORTH = r"[0-9@]|[(\[]at[)\]]|[0-9A-Fa-f]:[0-9A-Fa-f]|\x20dot\x20"
BEFORE, AFTER = 32, 16


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """Luhn checksum of a string of digits."""
    n = F.length(d)
    values = F.transform(F.split(F.reverse(d), ""), lambda x, i: F.when(i % 2 == 0, x.cast("int")).otherwise(
        F.when(x.cast("int") >= 5, x.cast("int") * 2 - 9).otherwise(x.cast("int") * 2)))
    return F.when(n > 0, F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0).otherwise(False)


def valid(kind: Column, match: Column) -> Column:
    """The checks of the base kinds on a match of their pattern."""
    d = digits(match)
    n = F.length(d)
    parts = F.transform(F.split(match, r"\."), lambda x: F.ltrim(x, F.lit("0")))
    small = F.forall(parts, lambda x: (F.length(x) < 3) | ((F.length(x) == 3) & (x <= "255")))
    return (F.when(kind == "email", True).when(kind == "ip", small)
            .when(kind == "card", n.between(13, 19) & luhn(F.when(n.between(13, 19), d).otherwise("0")))
            .otherwise(n.between(9, 15)))


def found(text: Column, kind: str, pattern: str, base: bool, worth: Column) -> Column:
    """Every leftmost match with the length of the text before it and a window of context.

    ``split`` and ``regexp_extract_all`` walk the same matches, so piece i ends where match i starts.
    """
    m = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    p = F.split(text, pattern, -1)
    one = F.transform(F.arrays_zip(m.alias("m"), F.slice(p, 1, F.size(m)).alias("p"), F.slice(p, 2, F.size(m)).alias("q")), lambda x: F.struct(
        F.lit(kind).alias("kind"), F.lit(base).alias("base"), x["m"].alias("match"),
        F.char_length(x["p"]).cast("bigint").alias("gap"), F.char_length(x["m"]).cast("bigint").alias("len"),
        F.substring(x["p"], -BEFORE, BEFORE).alias("before"), F.substring(x["q"], 1, AFTER).alias("after")))
    return F.when(worth, one)


def candidates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a record: uid, doc_id, ``found`` (for each generator its matches in order)."""
    d = df.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    d = d.withColumn("worth", F.col("text").rlike(WORTH))
    t, at, num = F.col("text"), F.col("text").contains("@"), F.col("text").rlike("[0-9]")
    needs = {"email": at, "ip": num, "card": num, "phone": F.col("text").contains("+")}
    loose = {"email": t.rlike(r"[(\[]at[)\]]|\x20at\x20[A-Za-z0-9-]{1,63}\x20dot\x20"), "ip": t.contains(":"), "card": num, "phone": num}
    every = [found(t, k, BASE[k], True, F.col("worth") & needs[k]) for k in KINDS] + \
            [found(t, k, LOOSE[k], False, F.col("worth") & loose[k]) for k in KINDS]
    return d.select(F.monotonically_increasing_id().alias("uid"), "doc_id",
                    F.when(F.col("worth"), F.array(*every)).alias("found"))


def spans(cands: DataFrame) -> DataFrame:
    """One row a candidate with its code point offsets (a running sum over its generator's matches)."""
    d = cands.filter(F.col("found").isNotNull()).select("uid", F.posexplode("found").alias("gen", "list")) \
        .select("uid", "gen", F.posexplode("list").alias("i", "x")).select("uid", "gen", "i", "x.*")
    w = Window.partitionBy("uid", "gen").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("len")).over(w)
    return d.withColumn("end", end).withColumn("start", F.col("end") - F.col("len")).drop("gap", "i", "gen")


FEATURES = ["f_kind", "f_digits", "f_len", "f_groups", "f_first", "f_last", "f_paren", "f_dots", "f_dashes", "f_spaces",
            "f_colons", "f_luhn", "f_cue", "f_against", "f_glued", "f_year", "f_letters"]


def with_features(d: DataFrame) -> DataFrame:
    """Format and context features of a candidate (kind, match, before, after)."""
    m = F.col("match")
    groups = F.filter(F.split(m, "[^0-9A-Za-z]+"), lambda x: F.length(x) > 0)
    flag = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    cue = F.lit(False)
    for k in KINDS:
        cue = F.when(F.col("kind") == k, F.col("before").rlike(CUES[k])).otherwise(cue)
    count = lambda p: F.regexp_count(m, F.lit(p)).cast("double")
    kind = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("double")
    d = d.withColumns({
        "f_kind": kind, "f_digits": count("[0-9]"), "f_len": F.char_length(m).cast("double"),
        "f_groups": F.size(groups).cast("double"), "f_first": flag(F.length(F.get(groups, F.lit(0)))),
        "f_last": flag(F.length(F.get(groups, F.size(groups) - 1))), "f_paren": count(r"[(\[]"), "f_dots": count(r"\."),
        "f_dashes": count("-"), "f_spaces": count(" "), "f_colons": count(":"), "f_luhn": flag(luhn(digits(m))),
        "f_cue": flag(cue), "f_against": flag(F.col("before").rlike(AGAINST)),
        "f_glued": flag(F.col("before").rlike(r"[0-9A-Za-z./:+-]$") | F.col("after").rlike("^(?:[0-9A-Za-z/:+-]|[.][0-9])")),
        "f_year": flag(m.rlike(r"(?<![0-9])(?:19|20)[0-9]{2}(?![0-9])")), "f_letters": count("[A-Za-z]")})
    return d


# Labelled formats (# a digit, * a hex digit) the trees are fitted on: kind, format, and
# whether it is personal data with a cue before it, with neither cue nor counter-cue, and with a
# counter-cue.
FORMATS = [
    ("phone", "(###) ###-####", 1, 1, 0), ("phone", "###-###-####", 1, 1, 0), ("phone", "###.###.####", 1, 1, 0),
    ("phone", "### ### ####", 1, 0, 0), ("phone", "## ## ## ## ##", 1, 0, 0), ("phone", "####-##-##", 0, 0, 0),
    ("phone", "##/##/####", 0, 0, 0), ("phone", "## ### ###", 0, 0, 0), ("phone", "20##-##-##", 0, 0, 0),
    ("phone", "### ## ##", 0, 0, 0), ("phone", "##.##.##", 0, 0, 0), ("phone", "### ### ### ###", 0, 0, 0),
    ("card", "####.####.####.####", 2, 2, 0), ("card", "####/####/####/####", 2, 2, 0), ("card", "####/##/##", 0, 0, 0),
    ("card", "####.##.####", 0, 0, 0), ("card", "####_######_#####", 2, 0, 0),
    ("ip", "****:****:****:****:****:****:****:****", 1, 1, 0), ("ip", "****:***:*:***:****:**:*:****", 1, 1, 0),
    ("ip", "##:##:##:##", 0, 0, 0), ("ip", "##:##:##:##:##:##", 0, 0, 0), ("ip", "*:*:*:*", 0, 0, 0),
    ("email", "mail##(at)host.com", 1, 1, 1), ("email", "name.two [at] site [dot] org", 1, 1, 1),
    ("email", "word(at)word(dot)word(dot)word", 1, 0, 0), ("email", "mail_##[at]host[dot]net", 1, 1, 1),
    ("email", "name at site dot org", 1, 0, 0), ("email", "mail.## at host## dot com", 1, 0, 0), ("email", "it at this dot here", 1, 0, 0),
    ("phone", "#######", 1, 0, 0), ("phone", "##########", 1, 0, 0), ("phone", "###########", 1, 0, 0), ("phone", "########", 1, 0, 0),
    ("ip", "****:***::*", 1, 1, 0), ("ip", "****::***:****", 1, 1, 0), ("ip", "****:****:*::****:**", 1, 1, 0), ("ip", "##::##", 0, 0, 0), ("ip", "*::*", 0, 0, 0)]
LEADS = {"cue": {"email": "my email is ", "ip": "from host address ", "card": "paid by card ", "phone": "phone me at "},
         "none": ["and then it was ", "the other one, ", "", "so we have "],
         "against": ["order no ", "invoice ref ", "version ", "see page ", "dated, date "]}
LABELLED_ROWS = 8000


def labelled(spark: SparkSession, rows: int = LABELLED_ROWS) -> DataFrame:
    """``rows`` labelled candidates, filled from FORMATS by hash: the bounded sample of the fit."""
    fmt = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(f).alias("fmt"), F.lit(a).alias("a"), F.lit(b).alias("b"),
                             F.lit(c).alias("c")) for k, f, a, b, c in FORMATS])
    d = spark.range(0, rows, 1, 2).withColumn("x", F.element_at(fmt, (F.pmod("id", F.lit(len(FORMATS))) + 1).cast("int")))
    digit = lambda n: lambda c, i: F.pmod(F.xxhash64(F.col("id"), i), F.lit(n))
    made = F.array_join(F.transform(F.split("x.fmt", ""), lambda c, i: F.when(c == "#", digit(10)(c, i).cast("string"))
                                    .when(c == "*", F.lower(F.hex(digit(16)(c, i)))).otherwise(c)), "")
    # Cards: half of the rows get the last digit that makes the checksum right.
    fixed = made
    for last in range(10):
        t = F.concat(F.substring(made, 1, F.length(made) - 1), F.lit(str(last)))
        fixed = F.when(luhn(digits(t)), t).otherwise(fixed)
    how = F.pmod(F.xxhash64("id", F.lit("how")), F.lit(3))
    pick = lambda k: F.element_at(F.array(*[F.lit(v) for v in LEADS[k]]), (F.pmod(F.xxhash64("id", F.lit(k)), F.lit(len(LEADS[k]))) + 1).cast("int"))
    cue = F.lit("")
    for k in KINDS:
        cue = F.when(F.col("x.kind") == k, F.lit(LEADS["cue"][k])).otherwise(cue)
    d = d.withColumn("kind", F.col("x.kind")) \
        .withColumn("match", F.when((F.col("x.kind") == "card") & (F.pmod(F.xxhash64("id", F.lit("l")), F.lit(2)) == 0), fixed).otherwise(made)) \
        .withColumn("before", F.when(how == 0, cue).when(how == 1, pick("none")).otherwise(pick("against"))) \
        .withColumn("after", F.lit(" and "))
    label = F.when(how == 0, F.col("x.a")).when(how == 1, F.col("x.b")).otherwise(F.col("x.c"))
    return d.select("id", "kind", "match", "before", "after",
                    F.when(label == 2, luhn(digits(F.col("match"))).cast("double")).otherwise(label.cast("double")).alias("label"))


def scored(d: DataFrame, model) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    v = VectorAssembler(inputCols=FEATURES, outputCol="_v").transform(with_features(d))
    return model.transform(v).withColumn("score", F.get(vector_to_array("probability"), F.lit(1))) \
        .drop("_v", "rawPrediction", "probability", "prediction", *FEATURES)


def fit(spark: SparkSession, rows: int = LABELLED_ROWS, precision: float = 0.995):
    """Boosted trees fitted on four fifths of the labelled rows, and for each kind the lowest score at
    which the held-out fifth still has ``precision`` (no score qualifies: nothing is added)."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    d = labelled(spark, rows)
    fold = F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(5)) == 0
    train = VectorAssembler(inputCols=FEATURES, outputCol="_v").transform(with_features(d.filter(~fold)))
    model = GBTClassifier(featuresCol="_v", labelCol="label", maxDepth=4, maxIter=12, stepSize=0.3, seed=7).fit(train)
    held = scored(d.filter(fold), model)
    w = Window.partitionBy("kind").orderBy(F.desc("score")).rangeBetween(Window.unboundedPreceding, 0)
    good = held.withColumn("p", F.avg("label").over(w)).filter((F.col("p") >= precision) & (F.col("score") > 0.5))
    return model, {r["kind"]: r["t"] for r in good.groupBy("kind").agg(F.min("score").alias("t")).collect()}


def select(found_spans: DataFrame, model, thresholds: dict[str, float]) -> DataFrame:
    """uid, kind, start, end, base: base spans that pass their checks, and added spans.  Where added
    candidates overlap they become one span; where they overlap a base span, that span alone stays."""
    base = found_spans.filter("base").filter(valid(F.col("kind"), F.col("match"))).withColumn("score", F.lit(1.0))
    at = F.lit(None).cast("double")
    for k, t in thresholds.items():
        at = F.when(F.col("kind") == k, F.lit(t)).otherwise(at)
    more = scored(found_spans.filter(~F.col("base")), model).filter(F.col("score") >= at)
    cols = ["uid", "kind", "start", "end", "base", "score"]
    both = base.select(*cols).unionByName(more.select(*cols))
    w = Window.partitionBy("uid").orderBy("start", "end", "kind", "base")
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    d = both.withColumn("new", F.when(F.col("start") < reach, 0).otherwise(1)) \
        .withColumn("island", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    isl = Window.partitionBy("uid", "island")
    d = d.withColumn("has_base", F.max(F.col("base").cast("int")).over(isl))
    kept = d.filter("base").select("uid", "kind", "start", "end", "base")
    added = d.filter("has_base = 0").groupBy("uid", "island").agg(
        F.max_by("kind", F.struct("score", "kind")).alias("kind"), F.min("start").alias("start"), F.max("end").alias("end")) \
        .select("uid", "kind", "start", "end", F.lit(False).alias("base"))
    return kept.unionByName(added)


def _joined(items: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(items), lambda x: F.concat_ws(
        ":", F.element_at(F.array(*[F.lit(k) for k in KINDS]), x["k"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def detect(df: DataFrame, key: str = "doc_id", text: str = "text", fitted=None) -> DataFrame:
    """One row a record: doc_id, counts of base spans, digest of the base spans, all spans."""
    model, thresholds = fitted or fit(df.sparkSession)
    cands = materialize(candidates(df, key, text), "pii-candidates")
    chosen = select(spans(cands), model, thresholds)
    k = F.array_position(F.array(*[F.lit(x) for x in KINDS]), F.col("kind")).cast("int")
    item = F.struct(k.alias("k"), "start", "end")
    n = [F.count(F.when(F.col("base") & (F.col("kind") == x), 1)).alias(f"n_{x}") for x in KINDS]
    per = chosen.groupBy("uid").agg(*n, F.collect_list(F.when(F.col("base"), item)).alias("_b"), F.collect_list(item).alias("_a"))
    per = per.select("uid", *[f"n_{x}" for x in KINDS], F.sha2(_joined(F.col("_b")), 256).alias("base_sha256"),
                     _joined(F.col("_a")).alias("spans"))
    out = cands.select("uid", "doc_id").join(per, "uid", "left")
    return out.select("doc_id", *[F.coalesce(F.col(f"n_{x}"), F.lit(0)).cast("bigint").alias(f"n_{x}") for x in KINDS],
                      F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"),
                      F.coalesce("spans", F.lit("")).alias("spans"))
