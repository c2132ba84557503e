"""Secret scans with a random forest that removes false positives (operator 1, DataFrame functions only).

Candidates are long runs of the letters that keys are written in, and, whatever their letters, whole values of at least six that
are assigned to a name for keys (up to the closing quote, or without quotes up to white space, a quote, comma, semicolon or
bracket) or stand as the password in an address with user:password. A run inside such a value is a candidate too. Each has numbers on its length, its character
transitions, its dictionary coverage, the path it stands in (an address or file name around it) and the words beside it. A
random forest, trained on labelled findings, gives each candidate a score; those under ``THRESHOLD`` are false positives.

Labelled findings are rows (doc_id, start, end, secret). Where none are given, findings are labelled by strict rules that
leave unclear ones out: an assignment of a quoted mixed value to a name for keys is a secret; addresses, file names, plain
words and digit runs are not. The forest sees at most ``MAX_LABELLED`` findings, those with the smallest hashes.

The dictionary is the set of letter triples in the words of at least ``TRIPLE_SHARE`` of all documents; its size is bounded by the
number of triples of ASCII letters. Scoring is the forest's own JVM code.

Defined cases: null and empty texts have no candidates; repeated rows give their findings each; without labelled findings
of both kinds every candidate is kept with a null score; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm.common import Scratch, let
from voxloom.llm.private_data import found
from voxloom.session import read_table, spread

CANDIDATE = r"(?:(?<![A-Za-z0-9+/_=-])|\G)[A-Za-z0-9+/_-]{16,}+={0,2}+"
MAX_LABELLED, TREES, DEPTH, THRESHOLD, TRIPLE_SHARE = 10_000, 20, 6, 0.5, 0.002
#: Fixed: names that keys are assigned to.
NAMES = ("token", "secret", "password", "passwd", "pwd", "apikey", "api_key", "key", "access_key", "auth", "bearer", "credential")
#: What stands before an assigned value, with its opening quote, and before the password of an address; whole matches of both.
ASSIGNS = "(?i:" + "|".join(NAMES) + r")[\"'`]?[ \t]*+[=:]{1,2}[ \t]*+"
LOGIN = r"://[^ \t-\r/:@\"'`<>]*+:"
ASSIGNED = ASSIGNS + r"(?:\"[^\"\r\n]{6,}+\"|'[^'\r\n]{6,}+'|`[^`\r\n]{6,}+`|[^ \t-\r\"'`,;<>(){}\[\]]{6,}+)"
ADDRESS = LOGIN + r"[^ \t-\r/@\"'`<>]{6,}+@"
FEATURES = (
    "length", "digit_share", "upper_share", "symbol_share", "transitions", "distinct_share", "covered", "in_path", "in_mail",
    "named", "assigned", "quoted", "one_case_hex",
)


SPAN = "array<struct<start:int,end:int,value:string,before:string,after:string,login:boolean>>"


def values(text: Column, pattern: str, lead: str, login: bool) -> Column:
    """The values in the matches of ``pattern``: what follows ``lead``, without a closing quote or @; array as in ``SPAN``."""

    def placed(m: Column) -> Column:
        value = F.regexp_replace(F.regexp_replace(m["text"], f"^(?:{lead})[\"'`]?", ""), "[\"'`]$" if not login else "@$", "")
        head = F.regexp_extract(m["text"], f"^(?:{lead})[\"'`]?", 0)
        start = m["start"] + F.char_length(head)
        return let(F.struct(start.alias("start"), (start + F.char_length(value)).alias("end"), value.alias("value"), head.alias("head")), lambda v: F.struct(
            v["start"].alias("start"), v["end"].alias("end"), v["value"].alias("value"),
            F.lower(F.right(F.concat(m["before"], v["head"]), F.lit(24))).alias("before"),
            F.substring(text, v["end"] + 1, F.lit(24)).alias("after"), F.lit(login).alias("login"),
        ))

    return F.when(text.rlike(pattern), F.transform(found(text, pattern), placed)).otherwise(F.array().cast(SPAN))


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, row, start, end, value, before, after, login) of every candidate; before and after: up to 24 code points beside it;
    login: whether it is the password of an address."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), text.alias("text"))
    runs = F.transform(
        found(F.col("text"), CANDIDATE),
        lambda m: F.struct(
            m["start"].alias("start"), m["end"].alias("end"), m["text"].alias("value"),
            F.lower(F.right(m["before"], F.lit(24))).alias("before"),
            F.substring(F.col("text"), m["end"] + 1, F.lit(24)).alias("after"), F.lit(False).alias("login"),
        ),
    )
    runs = F.when(F.col("text").rlike("[A-Za-z0-9+/_-]{16}"), runs).otherwise(F.array().cast(SPAN))

    def others(taken: Column, more: Column) -> Column:
        return F.filter(more, lambda v: ~F.exists(taken, lambda t: (t["start"] == v["start"]) & (t["end"] == v["end"])))

    text = F.col("text")
    hits = let(values(text, ADDRESS, LOGIN, True), lambda logins: let(
        F.concat(logins, others(logins, values(text, ASSIGNED, ASSIGNS, False))), lambda told: F.concat(told, others(told, runs))
    ))
    return rows.select("doc_id", "row", F.explode(hits).alias("m")).select("doc_id", "row", "m.*")


def frequent_triples(docs: DataFrame) -> DataFrame:
    """(triple) of the letter triples, anywhere in the words, that at least ``TRIPLE_SHARE`` of the documents hold, lower-cased."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit("[a-z]{3,}+"), F.lit(0)))
    triples = F.array_distinct(F.regexp_extract_all(F.array_join(words, " "), F.lit("(?=([a-z]{3}))"), F.lit(1)))
    counts = docs.select(F.explode(triples).alias("triple")).groupBy("triple").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= TRIPLE_SHARE * docs.count()).select("triple")


def classes(value: Column) -> Column:
    """The value with each character replaced by its class: d, l, u or s."""
    out = F.regexp_replace(value, "[^A-Za-z0-9]", "!")
    return F.translate(
        out, "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ!", "d" * 10 + "l" * 26 + "u" * 26 + "s"
    )


def described(found_ones: DataFrame, triples: DataFrame) -> DataFrame:
    """Candidates with their ``FEATURES`` as doubles; the triples, whose number is bounded, come as one set."""
    known = triples.agg(F.array_sort(F.collect_set("triple")).alias("known"))
    told = [r["known"] for r in known.collect()][0] or [""]
    length = F.char_length("value").cast("double")
    kinds = classes(F.col("value"))
    share = lambda k: F.char_length(F.regexp_replace(kinds, f"[^{k}]+", "")) / length
    places = F.sequence(F.lit(1), F.greatest(F.char_length("value") - 2, F.lit(1)))
    low = F.lower("value")
    hit = F.filter(places, lambda i: F.substring(low, i, F.lit(3)).isin(told))
    changes = F.filter(places, lambda i: F.substring(kinds, i, F.lit(1)) != F.substring(kinds, i + 1, F.lit(1)))
    flag = lambda c: c.cast("double")
    named = F.col("before").rlike("(?:" + "|".join(NAMES) + r")[^a-z0-9]{0,12}$")
    return found_ones.withColumns({
        "length": F.least(length, F.lit(256.0)),
        "digit_share": share("d"), "upper_share": share("u"), "symbol_share": share("s"),
        "transitions": F.size(changes) / length,
        "distinct_share": F.size(F.array_distinct(F.split("value", ""))) / length,
        "covered": F.size(hit) / F.size(places),
        "in_path": flag(~F.col("login") & (F.contains("value", F.lit("/")) | F.col("before").rlike(r"[/\\.]$|https?:[^ ]*$") | F.col("after").rlike(r"^[/\\]|^\.[a-z]"))),
        "in_mail": flag(~F.col("login") & (F.startswith("after", F.lit("@")) | F.endswith("before", F.lit("@")))),
        "named": flag(named | F.col("login")),
        "assigned": flag(F.col("before").rlike(r"[=:][ \t]*[\"'`]?$")),
        "quoted": flag(F.col("before").rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]")),
        "one_case_hex": flag(F.col("value").rlike("^(?:[0-9a-f]++|[0-9A-F]++)$")),
    })


def rule_label() -> Column:
    """1.0: surely a secret, 0.0: surely none, null: unclear."""
    mixed = (F.col("digit_share") > 0.1) & (F.col("digit_share") < 0.95) & (F.col("covered") < 0.5)
    sure = (F.col("named") == 1) & (F.col("assigned") == 1) & (F.col("quoted") == 1) & mixed
    never = (F.col("in_path") == 1) | (F.col("in_mail") == 1) | (F.col("digit_share") == 0) | (F.col("digit_share") > 0.97) | (F.col("covered") > 0.7)
    plain = (F.col("quoted") == 0) & (F.col("digit_share") == 0) & (F.col("symbol_share") == 0) & (F.col("covered") > 0.9)
    return F.when(sure, F.lit(1.0)).when((never & (F.col("named") == 0)) | plain, F.lit(0.0))


def labelled(rows: DataFrame, findings: DataFrame | None) -> DataFrame:
    """Candidates with a label, at most ``MAX_LABELLED``."""
    if findings is None:
        known = rows.withColumn("label", rule_label()).where("label IS NOT NULL")
    else:
        given = findings.where("secret IS NOT NULL").groupBy("doc_id", "start", "end").agg(F.max(F.col("secret").cast("double")).alias("label"))
        known = rows.join(given, ["doc_id", "start", "end"])
    n, space = known.count(), 1 << 20
    share = space if n <= MAX_LABELLED else int(space * MAX_LABELLED * 0.95 / n)
    return known.where(F.pmod(F.xxhash64("value", "before", "doc_id", "start"), F.lit(space)) < share).limit(MAX_LABELLED)


def scan(docs: DataFrame, findings: DataFrame | None = None) -> DataFrame:
    """(doc_id, start, end, value, score, secret) of every candidate; start and end in code points, end exclusive."""
    docs = docs.select("doc_id", "text")
    rows = Scratch.write(described(candidates(docs), frequent_triples(docs)), "candidates")
    table = VectorAssembler(inputCols=list(FEATURES), outputCol="_v").transform(rows)
    sample = Scratch.write(labelled(rows, findings).select("label", *FEATURES), "labelled")
    kinds = sample.select("label").distinct().count()
    if kinds < 2:
        return rows.select("doc_id", "start", "end", "value", F.lit(None).cast("double").alias("score"), F.lit(True).alias("secret"))
    forest = RandomForestClassifier(
        featuresCol="_v", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=7, probabilityCol="_p", rawPredictionCol="_r", predictionCol="_c"
    )
    model = forest.fit(VectorAssembler(inputCols=list(FEATURES), outputCol="_v").transform(sample.coalesce(1)))
    scored = model.transform(table).withColumn("score", vector_to_array("_p")[1])
    return scored.select("doc_id", "start", "end", "value", "score", (F.col("score") >= THRESHOLD).alias("secret"))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query over all ``documents``: every finding; values leave as hashes."""
    got = scan(spread(read_table(spark, sf_dir, "documents")))
    return got.select(
        "doc_id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"),
        F.sha2("value", 256).alias("value_sha256"), "score", "secret",
    )
