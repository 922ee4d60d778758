"""Secret scans: a random forest removes false positives.  DataFrame operations and Spark's own forest only.

Candidates are all runs of at least ``LEAST`` characters of ``A-Z a-z 0-9 + / _ -`` in a word, keys whose published format
has dots (JWT, SG), and values of at least ``SHORT`` characters, some other marks among them, right after an assignment to a
credential word (in the word itself or the two words before it).  Each is described by its length,
its character transitions (changes between lower case, upper case and digits, long consonant runs), the share of it
that a dictionary covers (the corpus's most frequent short words, counted over all documents), its path (the
document's source, and path marks in the word) and its neighbouring words (credential words and assignment
signs before it, quotes around it).  In a word of several candidates these are read from what stands between a candidate and the
next ones, the assignment from the text after the last of ``, ; & | { } [ ] ( )`` before it.  A random forest trained from labelled findings gives the probability that a candidate
is a secret.

``scan`` takes labelled findings as a parameter (doc_id, word, label); without them it labels what is certain by itself:
keys of a published format and values with letters and digits that are assigned to a credential word are
secrets, candidates of letters only that the dictionary covers by half, or of digits only, are none; the rest is
unlabelled and left to the forest.  Only documents whose crc32(doc_id as text) mod 3 is not 1 train.  At most
``TRAIN_ROWS`` findings of each label (those with the least hashes) are used: a bounded, documented sample.

Defined cases: NULL or empty text has no candidates; NULL source is a path of its own; repeated rows give repeated
findings; texts are read whole; if the labelled findings lack one of the labels there is no forest, and only
findings labelled as secrets are reported as such; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterbill.llm.common import stored

LEAST, SHORT = 16, 6
TRAIN_ROWS = 10_000
TREES, DEPTH = 20, 6
DICTIONARY = 150
THRESHOLD = 0.5
CREDENTIAL = "passw|passwd|pwd|secret|token|api.?key|access.?key|auth|bearer|credential|private.?key|signature"
# Published formats of keys.
FORMATS = (r"^AKIA[0-9A-Z]{16}$|^ASIA[0-9A-Z]{16}$|^gh[pousr]_[0-9A-Za-z]{36,}$|^glpat-[0-9A-Za-z_-]{20,}$|^xox[abprs]-[0-9A-Za-z-]{10,}$"
           r"|^sk_live_[0-9A-Za-z]{16,}$|^AIza[0-9A-Za-z_-]{35}$|^SG\.[0-9A-Za-z_.-]{16,}$|^eyJ[0-9A-Za-z_.-]{10,}$")
RUN = f"[A-Za-z0-9+/_-]{{{LEAST},}}"
DOTTED = r"(?<![A-Za-z0-9+/_-])(?:eyJ[0-9A-Za-z_-]{10,}\.[0-9A-Za-z_-]{10,}(?:\.[0-9A-Za-z_-]+)?|SG\.[0-9A-Za-z_-]{16,}(?:\.[0-9A-Za-z_-]+)?)"
NAMED = f"(?i:{CREDENTIAL})[A-Za-z0-9_-]{{0,24}}[\"'`]?"
VALUE = f"[A-Za-z0-9+/_!@#$%^*~-]{{{SHORT},}}"
MARK = "\x01"                       # set before a word that the words before it assign
# the look at one character spares the look for the credential word nearly everywhere
ASSIGNED = f"(?<=[=:\"'`{MARK}])(?:(?<={NAMED}[=:]{{1,2}}[\"'`]?)|(?<={MARK}[\"'`]?)){VALUE}"
CANDIDATE = f"{DOTTED}|{ASSIGNED}|{RUN}"
FEATURES = ["f_length", "f_digits", "f_upper", "f_transitions", "f_runs", "f_dictionary", "f_path", "f_marks", "f_credential",
            "f_assigned", "f_quoted"]


def frequent_words(docs: DataFrame, size: int = DICTIONARY) -> list[str]:
    """The corpus's most frequent words of three to five letters a-z, over all documents; ``size`` bounds the list."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(?<![^\s])([a-z]{3,5})(?![^\s.,!?])"), 1)).alias("w"))
    top = words.groupBy("w").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").limit(size)
    return [r.w for r in top.collect()]


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, source, at (number of the word), run (number in the word), value, lead, word and its neighbours, of every candidate.

    ``word`` is the word from the candidate before to the one after; ``lead`` is what of it stands before the value, the candidate
    before included."""
    words = F.split("text", r"[\x20\x09-\x0D]+")
    near = lambda ws, i, d: F.coalesce(F.try_element_at(ws, (i + 1 + d).cast("int")), F.lit(""))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                        F.col("text").cast("string").alias("text")) \
        .withColumn("assigns", F.col("text").rlike(f"{NAMED}[\\x20\\x09-\\x0D]*[=:]{{1,2}}[\\x20\\x09-\\x0D]*[\"'`]?{VALUE}")) \
        .filter(F.col("assigns") | F.col("text").rlike(f"{RUN}|{DOTTED}")).withColumn("ws", words)
    before = lambda ws, at: F.concat_ws(" ", F.when(at > 1, near(ws, at, -2)), F.when(at > 0, near(ws, at, -1)))
    marked = lambda w, i: F.when(F.col("assigns") & (F.length(w) >= SHORT) & before(F.col("ws"), i).rlike(f"{NAMED} ?[=:]{{1,2}}$"),
                                 F.concat(F.lit(MARK), w)).otherwise(w)
    hits = F.filter(F.transform("ws", lambda w, i: F.struct(i.alias("at"), marked(w, i).alias("word"))),
                    lambda x: (F.length(x["word"]) >= F.when(F.col("assigns"), SHORT).otherwise(LEAST)) & x["word"].rlike(CANDIDATE))
    found = plain.select("doc_id", "source", "ws", F.explode(hits).alias("hit"))
    # every candidate with the gap before it; the last gap is the rest of the word, with an empty value
    parts = lambda group: F.regexp_extract_all(F.col("hit.word"), F.lit(f"(?s)(.*?)({CANDIDATE}|$)"), group)
    at = F.col("hit.at")
    found = found.select("doc_id", "source", at.alias("at"), before(F.col("ws"), at).alias("before"),
                         F.transform(parts(1), lambda g: F.translate(g, MARK, "")).alias("gaps"), parts(2).alias("values"))
    found = found.select("doc_id", "source", "at", "before", "gaps", "values", F.posexplode("values").alias("run", "value")).filter("value != ''")
    run = F.col("run")
    lead = F.concat(F.when(run > 0, near(F.col("values"), run, -1)).otherwise(""), F.element_at("gaps", run + 1))
    return found.select("doc_id", "source", "at", "run", "value", lead.alias("lead"), "before", near(F.col("gaps"), run, 1).alias("rest")) \
        .select("doc_id", "source", "at", "run", "value", "lead", F.concat("lead", "value", "rest").alias("word"), "before")


def described(found: DataFrame, dictionary: list[str]) -> DataFrame:
    """Adds the features, and ``label`` where the finding is certain by itself."""
    value, word = F.col("value"), F.col("word")
    size = F.length(value)
    # what assigns the value: the words before too, unless another value ends in between
    own = F.lower(F.regexp_extract("lead", r"([^,;&|{}\[\]()]*)$", 1))
    context = F.when((F.col("run") == 0) & (F.length(own) == F.length("lead")), F.concat_ws(" ", F.lower("before"), own)).otherwise(own)
    rest = F.regexp_replace(F.lower(value), "|".join(sorted(dictionary, key=lambda w: (-len(w), w))) or "$.", "")
    count = lambda pattern: F.regexp_count(value, F.lit(pattern))
    out = found.select(
        "*", size.cast("double").alias("f_length"), (count("[0-9]") / size).alias("f_digits"), (count("[A-Z]") / size).alias("f_upper"),
        (count("(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])") / size).alias("f_transitions"),
        (count("(?i)[bcdfghjklmnpqrstvwxz]{4,}") / size).alias("f_runs"), (1 - F.length(rest) / size).alias("f_dictionary"),
        F.pmod(F.xxhash64(F.coalesce("source", F.lit("\0"))), F.lit(32)).cast("double").alias("f_path"),
        F.regexp_count(word, F.lit(r"[/\\.:]")).cast("double").alias("f_marks"),
        context.rlike(CREDENTIAL).cast("double").alias("f_credential"),
        context.rlike(r"[=:]\s*[\"']?$").cast("double").alias("f_assigned"),
        word.rlike("[\"'`]").cast("double").alias("f_quoted"))
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    sure = value.rlike(FORMATS) | ((F.col("f_credential") > 0) & (F.col("f_assigned") > 0) & mixed)
    none = value.rlike("^[0-9+/_-]+$") | (value.rlike("^[A-Za-z]+$") & (F.col("f_dictionary") >= 0.5))
    return out.withColumn("label", F.when(sure, 1.0).when(none, 0.0))


def train(labelled: DataFrame, train_rows: int = TRAIN_ROWS):
    """A random forest of findings with features and ``label``; None unless both labels occur."""
    h = F.xxhash64("doc_id", "at", "value")
    parts = [stored(labelled.filter(F.col("label") == x).withColumn("h", h).orderBy("h", "doc_id", "at", "run").limit(train_rows)
                    .select("label", *FEATURES), f"secrets-train-{int(x)}") for x in (0.0, 1.0)]
    if any(p.isEmpty() for p in parts):
        return None
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(parts[0].union(parts[1]))
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=7, featuresCol="features", labelCol="label").fit(rows)


def scan(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = THRESHOLD, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, at, value, kind, probability, is_secret of every candidate.

    ``labelled``: (doc_id, value, label) of known findings; else certain candidates label themselves."""
    dictionary = frequent_words(docs)
    found = stored(described(candidates(docs), dictionary), "secrets-found")
    known = found.filter(F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1, F.lit(True)))
    if labelled is not None:
        marks = labelled.select(F.col("doc_id").cast("long").alias("m_doc"), F.col("value").cast("string").alias("m_value"),
                                F.col("label").cast("double").alias("m_label")).distinct()
        known = known.join(marks, (F.col("doc_id") == F.col("m_doc")) & (F.col("value") == F.col("m_value"))) \
            .withColumn("label", F.col("m_label"))
    forest = train(known.filter("label is not null"), train_rows)
    if forest is None:
        judged = found.withColumn("probability", F.coalesce("label", F.lit(0.0)))
    else:
        judged = forest.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)) \
            .withColumn("p", vector_to_array("probability")).drop("probability").withColumn("probability", F.col("p")[1])
    return judged.select("doc_id", "at", "value", _kind().alias("kind"), "probability", (F.col("probability") >= threshold).alias("is_secret"))


def _kind() -> Column:
    return F.when(F.col("value").rlike(FORMATS), "key format").when((F.col("f_credential") > 0) & (F.col("f_assigned") > 0), "assigned") \
        .otherwise("other")
