"""Secret scans: candidate strings, told from false positives by a random forest.

Candidates are long runs of token characters with a digit or mixed case, and
what is assigned to a secret's name, of any characters but spaces and quotes.  Of
each the forest sees its length, its transitions between kinds of characters,
how much of it ordinary words and pronounceable letters cover, whether it lies
in a path, URL or address, and its neighbouring words.  It is trained from
reviewed findings, secrets and hard negatives.  Everything is DataFrame expressions and Spark ML: no Python
runs on the executors and no text is shuffled.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm.tables import stored


@dataclass(frozen=True)
class SecretForest:
    """`labelled_rows`: findings learned from per label, the first by a hash of
    the finding, so the fit's cost doesn't grow with the corpus."""
    least: int = 16
    trees: int = 30
    depth: int = 8
    seed: int = 7
    labelled_rows: int = 10_000
    threshold: float = 0.5


#: Words before a value that names it as a secret.
SECRET_WORDS = "token secret password passwd pwd apikey api_key access_key auth bearer credential private_key key"
#: Frequent words and syllables whose cover speaks for prose.
WORD_PARTS = (
    "the and ing ion tion ent for that with this from have her ere ate ver all wit thi his are not but was one our out "
    "sch ein ich und der die das ung lich keit heit ver gen ach ber les que des eau oir aux tre ment pour dans ell "
    "ado cion ndo ien mente ara con por est").split()

_RUN = "A-Za-z0-9+/_-"

def _candidate_pattern(least: int) -> str:
    """A value of six characters or more right after a secret's name and = or :, up to a space, a quote, the next
    assignment or closing punctuation; or a whole run of token characters that has a digit, or a capital after a
    small letter."""
    names = "|".join(sorted(SECRET_WORDS.split(), key=len, reverse=True))
    sign, space, inner = "\"'`", r"\s{0,3}", r"[.:)\]}>]"
    plain = rf"[^\s{sign},;&.:)\]}}>]++"
    # The short look-behinds come first: the long one is tried after an assignment only.
    assigned = (rf"(?<=[=:>\s{sign}])(?<=[=:]>?{space}[{sign}]?)"
                rf"(?<=(?i:{names})[{sign}]?{space}[=:]{{1,2}}>?{space}[{sign}]?)(?=[^\s{sign}=:>][^\s{sign}]{{5}})"
                rf"{plain}(?:(?:[,;&](?![\w.-]{{1,64}}[=:])|{inner}){{1,8}}+{plain}){{0,64}}+")
    return (rf"{assigned}|(?<![{_RUN}])(?=[{_RUN}]{{{least},}})"
            rf"(?:(?=[A-Za-z+/_-]*[0-9])|(?=[A-Z+/_-]*[a-z][a-z+/_-]*[A-Z]))[{_RUN}]++={{0,2}}")


def candidates(docs: DataFrame, least: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, start, secret, before, after): every candidate with its place (code
    points from 0) and up to 48 characters around it."""
    pattern = _candidate_pattern(least)
    text = F.coalesce(F.col(text_col), F.lit(""))
    parts = docs.select(F.col(id_col).alias("id"), text.alias("t")).select(
        "id", F.regexp_extract_all("t", F.lit(pattern), F.lit(0)).alias("hits"), F.split("t", pattern, -1).alias("gaps"))
    gaps, hits = F.col("gaps"), F.col("hits")
    # Where a hit starts: the lengths of all gaps up to it and of all hits before.
    ends = F.aggregate(
        hits, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
        lambda a, hit: F.struct(
            (a["at"] + F.length(F.get(gaps, F.size(a["starts"]))) + F.length(hit)).alias("at"),
            F.concat(a["starts"], F.array(a["at"] + F.length(F.get(gaps, F.size(a["starts"]))))).alias("starts")),
        lambda a: a["starts"])
    found = parts.select("id", F.explode_outer(F.transform(F.arrays_zip(
        hits.alias("secret"), ends.alias("start")), lambda x, i: F.struct(
            x["start"].cast("long").alias("start"), x["secret"].alias("secret"),
            F.right(F.get(gaps, i), F.lit(48)).alias("before"),
            F.left(F.get(gaps, i + 1), F.lit(48)).alias("after")))).alias("x"))
    return found.select("id", "x.*").filter("secret is not null")


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def featured(found: DataFrame) -> tuple[DataFrame, list[str]]:
    """``found`` with the forest's features and their names."""
    s, low = F.col("secret"), F.lower("secret")
    n = F.length("secret").cast("double")
    kinds = {"digits": "[0-9]", "uppers": "[A-Z]", "lowers": "[a-z]", "hexes": "[0-9a-fA-F]", "signs": "[+/_=-]"}
    parts = "|".join(sorted(WORD_PARTS, key=len, reverse=True))
    names = "|".join(sorted(SECRET_WORDS.split(), key=len, reverse=True))
    f = {
        "length": n,
        **{k: _count(s, p) / n for k, p in kinds.items()},
        # transitions between kinds of characters, and runs of one kind
        "letter_digit": _count(s, "(?<=[A-Za-z])[0-9]") / n,
        "digit_letter": _count(s, "(?<=[0-9])[A-Za-z]") / n,
        "case_changes": _count(s, "(?<=[a-z])[A-Z]|(?<=[A-Z])[a-z]") / n,
        "consonant_runs": _count(low, "[bcdfghjklmnpqrstvwxz]{4}") / n,
        "vowel_turns": _count(low, "(?<=[bcdfghjklmnpqrstvwxz])[aeiouy]") / n,
        "distinct": F.size(F.array_distinct(F.split(s, ""))) / n,
        # dictionary coverage
        "covered": (n - F.length(F.regexp_replace(low, parts, ""))) / n,
        # path, URL or address around or within
        "slashes": _count(s, "/"),
        "in_path": F.col("before").rlike(r"(?:/|\\|://\S*|@|[a-z]\.)$").cast("double"),
        "path_after": F.col("after").rlike(r"^(?:[/\\@.][A-Za-z])").cast("double"),
        # neighbouring words
        "assigned": F.col("before").rlike(r"[=:]\s*[\"']?$").cast("double"),
        "quoted": (F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']")).cast("double"),
        "named": F.lower("before").rlike(rf"(?:{names})[\"']?\s*[=:]?\s*[\"']?$").cast("double"),
        "word_before": F.col("before").rlike(r"[^\W\d_]{2,}[.,]?\s+$").cast("double"),
        "word_after": F.col("after").rlike(r"^[.,]?\s+[^\W\d_]{2,}").cast("double"),
    }
    return found.withColumns({f"f_{k}": v.cast("double") for k, v in f.items()}), [f"f_{k}" for k in f]


#: What stands before and after a finding, how its value is made (see `_made`) and its label.
REVIEWED = (
    # named values
    ('password="', '"', "mixed 12", 1), ("PASSWORD: ", "\n", "signs 10", 1), ("db_password = '", "'", "short", 1),
    ("the password=", " is for", "lowdig 8", 1), ('"passwd": "', '",', "mixed 16", 1), ("pwd=", ";", "short", 1),
    ('api_key: "', '"', "hex 32", 1), ("apikey=", "&", "mixed 24", 1), ("export API_KEY=", "\n", "upperdig 20", 1),
    ("X-Auth-Token: ", "\n", "hex 40", 1), ('token = "', '"', "hex 40", 1), ("token=", " ", "mixed 40", 1),
    ("Authorization: Bearer ", "\n", "mixed 36", 1), ('"client_secret": "', '"', "mixed 32", 1), ("secret = '", "'", "hex 18", 1),
    ("SECRET_KEY='", "'", "signs 24", 1), ("access_key=", " region", "upperdig 20", 1), ("AWS_SECRET_ACCESS_KEY=", "\n", "base64 40", 1),
    ("private_key: ", "\n", "base64 44", 1), ("credential=", ",", "mixed 20", 1), ("password=", " ", "hex 18", 1),
    # issued keys, wherever they stand
    ("found ", " in the logs", "AKIA", 1), (" ", " ", "AKIA", 1), ("clone with ", " please", "ghp_", 1), ("use ", ".", "sk-", 1),
    ("bot ", "\n", "xoxb-", 1), ("see ", ", then", "AKIA", 1),
    # hashes, identifiers and encodings
    ("commit ", "\n", "hex 40", 0), ("at commit ", " of the", "hex 20", 0), ("sha256:", "\n", "hex 64", 0), ("md5 sum ", " of", "hex 32", 0),
    ("image@sha256:", " pulled", "hex 64", 0), ('ETag: "', '"', "hex 32", 0), ("checksum ", " ok", "hex 40", 0), ("id ", " was", "uuid", 0),
    ('"request_id": "', '"', "uuid", 0), ("session ", " ended", "uuid", 0), ("data:image/png;base64,", '"', "base64 60", 0),
    ("src=\"data:font/woff2;base64,", '"', "base64 80", 0), ("integrity=sha384-", " ", "base64 64", 0),
    ("order no. ", " shipped", "digits 16", 0), ("call ", " now", "digits 16", 0), ("ISBN ", ",", "digits 17", 0), ("row ", " of", "digits 20", 0),
    # names, paths and words
    ("in ", " we", "words 3 2", 0), ("class ", " extends", "camel", 0), ("see ", ".", "camel", 0), ("open ", " and", "path", 0),
    ("https://host.org/", " for", "path", 0), ("the ", " of", "long word", 0), ("on ", " we met", "dated", 0), ("file ", ".txt", "dated", 0),
    ("release ", " of", "version", 0), ("/usr/lib/", ".so", "words 3 2", 0),
    # placeholders and plain words behind a name
    ('password="', '"', "placeholder", 0), ("password: ", "\n", "placeholder", 0), ("token: ", " for", "plain", 0), ("key: ", ",", "plain", 0),
    ("secret=", "\n", "placeholder", 0), ("api_key = ", "\n", "placeholder", 0), ("the key: ", " to", "plain", 0),
    ("password = ", "\n", "code", 0), ("token=", ")", "code", 0), ("password: ", " ", "digits 8", 0), ("key=", "\n", "long word", 0))
_PLAIN = ("required optional internal whatever unknown important different another something together primary foreign shared "
          "public default hidden missing present").split()
_PARTS = "main test data user file list item node view page load save read copy resource config service handler builder model".split()


def _made(kind: str, rng: random.Random) -> str:
    """A value of a kind, like `hex 40`."""
    lower, upper, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    signs = {"hex": "0123456789abcdef", "mixed": lower + upper + digits, "upperdig": upper + digits, "lowdig": lower + digits,
             "digits": digits, "base64": lower + upper + digits + "+/", "signs": lower + upper + digits + "!@#$%^*"}
    name, *size = kind.split()
    some = lambda of, n: "".join(rng.choice(of) for _ in range(n))
    if name in signs:
        return some(signs[name], int(size[0]))
    word = lambda: rng.choice(_PARTS)
    return {
        "short": lambda: some(upper, 1) + some(lower, 3) + some(digits, 2) + some("!@#$", 1) + some(lower, 2),
        "AKIA": lambda: "AKIA" + some(upper + "234567", 16), "ghp_": lambda: "ghp_" + some(lower + upper + digits, 36),
        "sk-": lambda: "sk-" + some(lower + upper + digits, 40),
        "xoxb-": lambda: "xoxb-" + some(digits, 11) + "-" + some(lower + upper + digits, 20),
        "uuid": lambda: "-".join(some("0123456789abcdef", n) for n in (8, 4, 4, 4, 12)),
        "words": lambda: "-".join(word() for _ in range(3)) + "-" + some(digits, 2),
        "camel": lambda: "".join(word().title() for _ in range(4)),
        "path": lambda: "/".join(word() for _ in range(4)) + some(digits, 1),
        "long": lambda: word() + word() + word() + word() + some(digits, 4), "plain": lambda: rng.choice(_PLAIN),
        "dated": lambda: f"20{some(digits, 2)}-0{rng.randint(1, 9)}-1{some(digits, 1)}-{word()}-{word()}",
        "version": lambda: f"{word()}-{word()}-{some(digits, 1)}.{some(digits, 1)}",
        "placeholder": lambda: rng.choice(["changeme", "your_password_here", "********", "xxxxxxxx", "<password>", "REPLACE_ME",
                                           "example", "TODO_set_me", "enter-your-key", "password123"]),
        "code": lambda: rng.choice(["os.environ['PASS']", "${DB_PASSWORD}", "get_password(user)", "config.secret_key", "None;return"]),
    }[name]()


def reviewed_findings(spark: SparkSession, values: int = 8, seed: int = 11) -> DataFrame:
    """(secret, before, after, label): the reviewed forms, each with some values, among words of a text."""
    rng = random.Random(seed)
    rows = []
    for before, after, kind, label in REVIEWED:
        for _ in range(values):
            left = " ".join(rng.choice(_PLAIN + WORD_PARTS) for _ in range(5))
            right = " ".join(rng.choice(_PLAIN + WORD_PARTS) for _ in range(5))
            rows.append((_made(kind, rng), (left + " " + before)[-48:], (after + " " + right)[:48], label))
    return spark.createDataFrame(rows, "secret string, before string, after string, label int")


def fit_secrets(labelled: DataFrame, params: SecretForest = SecretForest()) -> PipelineModel | None:
    """A forest from labelled findings (the columns of `candidates` and
    `label`).  Equal findings with equal surroundings count once.  None if
    there are no findings of both labels."""
    p = params
    # Each label's first rows by hash are one bounded top-k: no sort of all findings.
    own = labelled.filter("label in (0, 1)").select("secret", "before", "after", "label")
    taken = None
    for label in (0, 1):
        part = (own.filter(F.col("label") == label).distinct()
                .orderBy(F.xxhash64("secret", "before", "after"), "secret", "before", "after").limit(p.labelled_rows))
        taken = part if taken is None else taken.unionByName(part)
    rows, names = featured(taken)
    rows = stored(rows.select("label", *names), "findings")
    if rows.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=p.trees, maxDepth=p.depth,
                                    seed=p.seed, rawPredictionCol="_raw", probabilityCol="_probability",
                                    predictionCol="_prediction")
    assembler = VectorAssembler(inputCols=names, outputCol="features")
    return PipelineModel([assembler, forest.fit(assembler.transform(rows))])


def judged_candidates(found: DataFrame, model: PipelineModel | None, params: SecretForest = SecretForest()) -> DataFrame:
    """``found`` with `score` (the forest's share for a secret) and `is_secret`.
    Without a model every candidate stands, with a null score."""
    if model is None:
        return found.withColumns({"score": F.lit(None).cast("double"), "is_secret": F.lit(True)})
    rows, names = featured(found)
    return (model.transform(rows).withColumn("score", vector_to_array("_probability")[1])
            .withColumn("is_secret", F.col("score") >= params.threshold).select(*found.columns, "score", "is_secret"))


def scan_secrets(docs: DataFrame, findings: DataFrame | None = None, params: SecretForest = SecretForest(),
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, start, secret, score, is_secret) of every candidate in ``docs``.

    ``findings``: reviewed findings (secret, before, after, label), by default
    ``reviewed_findings``; nothing is learned from ``docs`` themselves.  Null and empty
    texts have no candidate; null ids and repeated rows give theirs again.
    """
    found = stored(candidates(docs, params.least, id_col, text_col), "candidates")
    model = fit_secrets(reviewed_findings(docs.sparkSession) if findings is None else findings, params)
    return judged_candidates(found, model, params).select(
        F.col("id").alias(id_col), "start", "secret", "score", "is_secret")
