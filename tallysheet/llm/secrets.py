"""Secret scan with a random forest for false-positive removal (DataFrame functions only).

Findings come from blank-delimited tokens.  A token that holds several assignments
(compact JSON, a query string) is cut in front of each, at ``&``, ``,``, ``;``, ``?``, ``#`` or an
opening bracket.  A part is a finding if it has ``MIN_LENGTH`` characters and a digit,
holds the format of an access key, or is a value of any length and any characters
assigned (``=`` or ``:``) to a key word such as ``password``, in its own token or the ones
before; a token of ``MIN_LENGTH`` none of whose parts is one counts whole.  The
password of an address (``://user:password@``) is a finding of its own with the key
``password``, a lone ``://user@`` one without key if it is long or a key.  What is no
secret is left to the forest.  Each finding is described by

* length, and the shares of digits, upper case, hexadecimal and other characters;
* character transitions: changes between character classes per character, and the
  entropy of its characters;
* dictionary coverage: the share of its characters in letter runs (of ``MAX_RUN`` letters at most) that are words of
  the corpus (standing alone in ``MIN_DOCUMENTS`` documents or more);
* path marks: slashes, dots, ``@`` and ``://``, and words that mark a placeholder;
* neighbouring words: a key word before it or behind it, an assignment, quotes.

A random forest (MLlib) trained on labelled findings scores all of them.  The
given tables label no findings, so the labelled ones are planted: ``PLANTS`` lines, each with words of the corpus around one
value, which is a secret made from random characters (keys, hexadecimal and base64 strings, platform tokens, passwords
and phrases) or something ordinary (words of the corpus, numbers, dates, addresses, paths, placeholders).  Both
kinds stand behind key words and in neutral places, so neither the place nor any single feature decides the label: the label is what was
planted.  The lines go through the same code as the texts.  ``labelled`` marks findings of the corpus whose format
decides by itself; that label is reported and measures the forest, which never sees it.  The words come from at most
``POOL_DOCUMENTS`` documents whose ``crc32(doc_id) mod 5`` is not 0.

Scale: findings come from one map over whole texts.  The corpus is read once more to
count in how many documents the findings' letter runs stand alone; those runs are
broadcast if at most ``MAX_BROADCAST`` were counted, else both sides are shuffled.  All
counts combine on the map side.

Defined cases: null and empty texts have no findings; a value in quotes ends at its
first blank; a separator inside a value cuts it only in front of another assignment;
a part cut out of a token has no neighbours but those in the text on its own side;
a token found twice in a text gives two findings; repeated rows give repeated findings, which count as one document
in the dictionary; a corpus without any word to plant beside gets score 0 everywhere.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallysheet.llm.staging import staged
from tallysheet.llm.toxicity import held_out

MIN_LENGTH = 12
MIN_DOCUMENTS = 3
MAX_RUN = 64
PLANTS = 12_000
POOL_DOCUMENTS, POOL_CHARS, POOL_WORDS = 1_000, 8_192, 5_000
MAX_BROADCAST = 1_000_000
TREES, DEPTH, SEED = 30, 10, 7
KEY_WORDS = r"(?i)(pass(word|wd|phrase)?|pwd|secret|token|api_?key|access_?key|auth|bearer|credential)"

#: A name with ``=`` or ``:`` and a value behind it; the scheme of an address is no name.
NAME = r"[A-Za-z_.\-][A-Za-z0-9_.\-]*+"
ASSIGNMENT = NAME + r"[\"']?[:=]++>?(?!//)(?=[^\s])"
OPENING = r"[(\"'\[{<]*"
#: Separators in front of an assignment; from the first of a run on, so long runs are read once.
CUT = r"(?<![&,;?#{\[(])[&,;?#{\[(]++(?=[(\"'\[{<]{0,8}+" + ASSIGNMENT + ")"
KEY_NAME = KEY_WORDS + r"[A-Za-z0-9_.\-]*[\"']?"
ENDS_ASSIGNED = KEY_NAME + r"[:=]+>?[\"'(\[{]*$"

#: The user and the password of an address, and an address that holds a password or a parameter named by a key word.
LOGIN = r"://([^/?#@:\s]*+)(?::([^/?#\s]*))?@"
CREDENTIALS = r"://[^/?#@:\s]*+:[^/?#\s]*@|://[^\s]*?[?&;#][A-Za-z0-9_.\-]*" + KEY_NAME + "="

#: Formats of access-key ids and platform tokens.
KEY_FORMAT = r"\b((AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|[spr]k_(live|test)_[A-Za-z0-9]{16,99})\b"
#: Words that mark a value as a stand-in.
PLACEHOLDER = r"(?i)(example|placeholder|changeme|your[_\-]|insert|x{6,}|\*{4,}|<[a-z _\-]+>|\$\{)"

FEATURES = ["length", "digits", "upper", "hexadecimal", "other", "transitions", "entropy", "coverage", "slashes", "dots",
            "at_sign", "scheme", "placeholder", "key_before", "key_behind", "assigned", "quoted"]


def _share(value: Column, keep: str) -> Column:
    """Share of the characters that match the class ``keep``."""
    return F.length(F.regexp_replace(value, f"[^{keep}]", "")) / F.greatest(F.length(value), F.lit(1))


def findings(documents: DataFrame) -> DataFrame:
    """``(doc_id, pos, token, before2, before, behind, key, value)``; ``pos`` is the token's number in its text."""
    def is_long(w: Column) -> Column:
        return (F.length(w) >= MIN_LENGTH) & (w.rlike("[0-9]") | w.rlike(KEY_FORMAT) | w.rlike(KEY_WORDS + r"[A-Za-z_]*[\"']?[:=].{4,}"))

    def has_sign(w: Column) -> Column:
        return F.contains(w, F.lit(":")) | F.contains(w, F.lit("="))

    def follows(before2: Column, before: Column) -> Column:
        """Whether the tokens before assign to a key word; the cheap test for a sign comes first."""
        return (has_sign(before) & (before.rlike(ENDS_ASSIGNED) | (before.rlike(r"^[:=]+>?[\"']*$") & before2.rlike(KEY_NAME + "$")))) | (
            has_sign(before2) & before2.rlike(ENDS_ASSIGNED) & before.rlike(r"(?i)^[\"']?(bearer|basic|token)$"))

    def at(i: Column) -> Column:
        return F.coalesce(F.get("tokens", i), F.lit(""))

    def candidate(i: Column) -> Column:
        w = at(i)
        return is_long(w) | (has_sign(w) & (w.rlike(KEY_NAME + r"[:=]+>?[^\s]") | w.rlike(LOGIN))) | follows(at(i - 2), at(i - 1))

    rows = documents.select("doc_id", F.split(F.coalesce("text", F.lit("")), r"\s+").alias("tokens"))
    rows = rows.withColumn("n", F.size("tokens"))
    rows = rows.withColumn("at", F.filter(F.sequence(F.lit(0), F.col("n") - 1), candidate))
    # An outer generator: no filter on the array is inferred and evaluated twice.
    rows = rows.select("doc_id", "tokens", F.explode_outer("at").alias("pos")).where("pos is not null")
    rows = rows.select("doc_id", "pos", *[at(F.col("pos") + i).alias(n) for n, i in (
        ("token", 0), ("before2", -2), ("before", -1), ("behind", 1))])

    def part(w: Column) -> Column:
        key = F.regexp_extract(w, f"^{OPENING}({NAME})[\"']?[:=]++>?(?!//)(?=[^\\s])", 1)
        value = F.regexp_replace(w, f"^{OPENING}({ASSIGNMENT})?[\"'(\\[{{]*", "")
        return F.struct(w.alias("part"), key.alias("key"), F.regexp_replace(value, r"(?<![\"'\])}>,;.!?:])[\"'\])}>,;.!?:]++$", "").alias("value"))

    # The fragment of an address is a part too.
    token = F.regexp_replace("token", r"(://[^\"'<>#]*+)#", "$1\x1f")
    parts = F.split(F.regexp_replace(token, CUT, "\x1f"), "\x1f")
    rows = rows.withColumn("parts", F.transform(parts, part))
    followed = follows(F.col("before2"), F.col("before"))

    def first(i: Column) -> Column:
        return F.forall(F.slice("parts", 1, i), lambda x: x["part"] == "")

    def kept(x: Column, i: Column) -> Column:
        return (x["value"] != "") & (is_long(x["part"]) | x["key"].rlike(KEY_WORDS) | (followed & first(i)))

    # Only the first part has the words before as neighbours, only the last part those behind.
    numbered = F.transform("parts", lambda x, i: F.struct(
        x["key"].alias("key"), x["value"].alias("value"), kept(x, i).alias("kept"),
        first(i).alias("first"), (i == F.size("parts") - 1).alias("last")))
    login = F.col("token").rlike(LOGIN)
    user, password = (F.regexp_extract("token", LOGIN, n) for n in (1, 2))
    lone = (password == "") & is_long(user)
    logins = F.when(login & ((password != "") | lone), F.array(F.struct(
        F.when(lone, "").otherwise("password").alias("key"), F.when(lone, user).otherwise(password).alias("value"),
        F.lit(True).alias("kept"), F.lit(False).alias("first"), F.lit(False).alias("last"))))
    rows = rows.withColumn("found", F.filter(numbered, lambda x: x["kept"]))
    rows = rows.withColumn("logins", logins)
    whole = F.struct(part(F.col("token"))["key"].alias("key"), part(F.col("token"))["value"].alias("value"), F.lit(True).alias("kept"),
                     F.lit(True).alias("first"), F.lit(True).alias("last"))
    rows = rows.withColumn("found", F.when(F.size("found") > 0, F.col("found")).when(is_long(F.col("token")), F.array(whole)))
    rows = rows.withColumn("found", F.concat(F.coalesce("found", F.array().cast(rows.schema["found"].dataType)),
                                             F.coalesce("logins", F.array().cast(rows.schema["found"].dataType))))
    rows = rows.select("doc_id", "pos", "token", "before2", "before", "behind", F.explode_outer("found").alias("x")).where("x is not null")
    return rows.select("doc_id", "pos", "token",
                       *[F.when(F.col(f"x.{side}"), F.col(n)).otherwise("").alias(n) for n, side in (
                           ("before2", "first"), ("before", "first"), ("behind", "last"))], "x.key", "x.value")


def _dictionary(documents: DataFrame, runs: DataFrame, max_broadcast: int) -> DataFrame:
    """The letter runs that stand alone as words in enough documents."""
    words = F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}]+"))
    alone = documents.select("doc_id", F.explode_outer(words).alias("run")).where("run is not null")
    known = F.broadcast(runs) if runs.count() <= max_broadcast else runs
    alone = alone.join(known, "run", "left_semi").distinct()
    return alone.groupBy("run").agg(F.count("*").alias("documents")).where(F.col("documents") >= MIN_DOCUMENTS).select("run")


def featured(documents: DataFrame, found: DataFrame, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """``found`` with the columns of ``FEATURES``."""
    value = F.col("value")
    classes = F.translate(value, string.ascii_lowercase + string.ascii_uppercase + string.digits,
                          "l" * 26 + "u" * 26 + "d" * 10)
    changes = F.length(F.regexp_replace(classes, r"(.)\1+", "$1")) - 1
    counts = F.transform(F.array_distinct(F.split(value, "")), lambda c: F.length(value) - F.length(F.replace(value, c, F.lit(""))))
    entropy = F.aggregate(counts, F.lit(0.0), lambda a, n: a - F.when(n > 0, n / F.length(value) * F.log2(n / F.length(value)))
                          .otherwise(F.lit(0.0)))
    nearby = F.concat_ws(" ", "before2", "before", "key")
    out = found.select(
        "*", F.length(value).cast("double").alias("length"), _share(value, "0-9").alias("digits"),
        _share(value, "A-Z").alias("upper"), _share(value, "0-9a-fA-F").alias("hexadecimal"),
        (1 - _share(value, "A-Za-z0-9")).alias("other"),
        F.greatest(changes / F.greatest(F.length(value), F.lit(1)), F.lit(0.0)).alias("transitions"),
        F.when(F.length(value) > 0, entropy).otherwise(F.lit(0.0)).alias("entropy"),
        (F.length(value) - F.length(F.replace(value, F.lit("/"), F.lit("")))).cast("double").alias("slashes"),
        (F.length(value) - F.length(F.replace(value, F.lit("."), F.lit("")))).cast("double").alias("dots"),
        F.contains(value, F.lit("@")).cast("double").alias("at_sign"),
        F.contains("value", F.lit("://")).cast("double").alias("scheme"),
        value.rlike(PLACEHOLDER).cast("double").alias("placeholder"),
        nearby.rlike(KEY_WORDS).cast("double").alias("key_before"),
        F.col("behind").rlike(KEY_WORDS).cast("double").alias("key_behind"),
        ((F.col("key") != "") | F.col("before").rlike("[:=]>?[\"'(]*$")).cast("double").alias("assigned"),
        F.col("token").rlike("[\"']").cast("double").alias("quoted"))
    parts = F.array_distinct(F.filter(F.split(F.lower(value), "[^a-z]+"), lambda r: F.length(r).between(3, MAX_RUN)))
    values = found.select("value").distinct()
    runs = values.select("value", F.explode(parts).alias("run"))
    words = _dictionary(documents, runs.select("run").distinct(), max_broadcast)
    covered = runs.join(words, "run").groupBy("value").agg(F.collect_set("run").alias("runs"))
    inside = F.aggregate(F.split(F.lower(value), "[^a-z]+"), F.lit(0),
                         lambda a, r: a + F.when(F.array_contains("runs", r), F.length(r)).otherwise(0))
    covered = covered.select("value", (inside / F.greatest(F.length(value), F.lit(1))).alias("coverage"))
    return out.join(covered, "value", "left").withColumn("coverage", F.coalesce("coverage", F.lit(0.0)))


def labelled(found: DataFrame) -> DataFrame:
    """Adds ``label``: 1 or 0 where the format decides it, else null."""
    value = F.col("value")
    secret = (value.rlike(f"^{KEY_FORMAT}$") & (F.col("placeholder") == 0)) | (
        value.rlike("^([0-9a-f]{16,64}|[0-9A-F]{16,64})$") & value.rlike("[a-fA-F]") & value.rlike("[0-9]")
        & (F.col("assigned") == 1) & (F.col("key_before") == 1))
    plain = (value.rlike(r"^[\w.+-]+@[\w-]+(\.[\w-]+)+$") | value.rlike(r"^\d{1,3}(\.\d{1,3}){3}(:\d+)?$")
             | value.rlike(r"^[\d .,()+/-]+$") | (F.col("placeholder") == 1)
             | (F.col("scheme") == 1))
    plain &= ~((F.col("scheme") == 1) & F.col("token").rlike(CREDENTIALS))
    return found.withColumn("label", F.when(secret, F.lit(1.0)).when(plain, F.lit(0.0)))


def word_pool(documents: DataFrame) -> DataFrame:
    """One row ``pool``: words of a bounded sample of the corpus, of documents a model may learn from."""
    free = documents.where(F.col("text").isNotNull() & ~held_out("doc_id"))
    ids = free.select("doc_id").where("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(POOL_DOCUMENTS)
    words = F.split(F.lower(F.substring("text", 1, POOL_CHARS)), r"[^\p{L}]+")
    rows = free.join(F.broadcast(ids), "doc_id").select(F.explode(words).alias("word")).where(F.length("word").between(3, 20))
    rows = rows.distinct().orderBy(F.xxhash64("word"), "word").limit(POOL_WORDS)
    return rows.agg(F.sort_array(F.collect_list("word")).alias("pool"))


def _pick(salt: int, n) -> Column:
    """A number below ``n`` from the row's ``id``; with another salt, another one."""
    return F.pmod(F.xxhash64(F.lit(SEED), F.lit(salt), "id"), F.lit(n) if isinstance(n, int) else n).cast("int")


def _one_of(salt: int, options: list) -> Column:
    return F.get(F.array(*[o if isinstance(o, Column) else F.lit(o) for o in options]), _pick(salt, len(options)))


def _random_text(salt: int, alphabet: str, least: int, most: int) -> Column:
    length = F.lit(least) + _pick(salt, most - least + 1)
    return F.array_join(F.transform(F.sequence(F.lit(1), length), lambda k: F.substr(
        F.lit(alphabet), (F.pmod(F.xxhash64(F.lit(salt), "id", k), F.lit(len(alphabet))) + 1).cast("int"), F.lit(1))), "")


#: What stands in front of a planted value and behind it, with a key word and without one.
KEYED = [("password: ", ""), ("password=", ""), ("pwd=", ""), ("token = ", ""), ('api_key="', '"'), ('{"secret": "', '"}'), ("auth: ", ""),
         ("Authorization: Bearer ", ""), ("the secret: ", ""), ("ACCESS_KEY=", ""), ("token: '", "'"), ("?auth=", "&page=2")]
NEUTRAL = [("", ""), ("see ", ""), ("(", ")"), ("ref=", ""), ("id: ", ""), ('"', '"'), ("commit ", ""), ("build ", "."), ("https://", ""), ("name=", ";")]


def planted_lines(spark: SparkSession, pool: DataFrame, n: int = PLANTS) -> DataFrame:
    """``(doc_id, text, planted, label)``: lines that hold one value known to be a secret (1) or ordinary (0)."""
    lower, upper, digits = string.ascii_lowercase, string.ascii_uppercase, string.digits
    rows = spark.range(0, n, 1, 4).withColumn("pool", pool.scalar()).where(F.size("pool") > 0)

    def word(salt: int) -> Column:
        return F.element_at("pool", _pick(salt, F.size("pool")) + 1)

    number = _random_text(31, digits, 1, 16)
    secrets = [
        _random_text(1, "0123456789abcdef", 16, 64), _random_text(2, "0123456789ABCDEF", 16, 40), _random_text(3, lower + upper + digits, 16, 48),
        _random_text(4, lower + digits, 12, 32), _random_text(5, lower + upper + digits + "+/", 20, 44), _random_text(6, lower + upper, 16, 40),
        F.concat(F.lit("AKIA"), _random_text(7, upper + digits, 16, 16)), F.concat(F.lit("ghp_"), _random_text(8, lower + upper + digits, 36, 36)),
        F.concat(F.lit("sk_live_"), _random_text(9, lower + upper + digits, 20, 30)),
        F.concat(F.initcap(word(10)), _random_text(11, digits, 1, 4), _one_of(12, ["", "!", "#", "$"])),
        F.concat(F.translate(word(13), "aeio", "4310"), _random_text(14, digits + "!?%", 1, 5)),
        F.concat(_random_text(15, lower + upper + digits + "!%^*_-", 8, 16), _random_text(16, digits, 1, 1)),
    ]
    ordinary = [
        word(17), word(18), F.concat_ws("-", word(19), word(20)), F.concat_ws("_", word(21), word(22), number), number,
        F.concat(F.lit("20"), _random_text(23, digits, 2, 2), F.lit("-0"), _random_text(24, "123456789", 1, 1), F.lit("-11")),
        F.concat_ws(".", _random_text(25, "123456789", 2, 2), _random_text(26, "123456789", 2, 3), _random_text(27, digits, 1, 2), _random_text(28, digits, 1, 2)),
        F.concat(word(29), F.lit("."), word(30), F.lit("@mail."), word(32), F.lit(".org")),
        F.concat(F.lit("/"), word(33), F.lit("/"), word(34), number, F.lit("."), word(35)),
        F.concat(word(36), F.lit(".com/"), word(37), F.lit("?page="), number),
        _one_of(38, ["required", "none", "nobody", "true", "false", "optional", "unknown", "basic", "enabled"]),
        _one_of(39, ["your_token_here", "changeme", "xxxxxxxxxxxx", "********", "<password>", "${SECRET_KEY}", "insert-key-here1"]),
        F.concat(F.lit("AKIA"), _random_text(40, upper + digits, 9, 9), F.lit("EXAMPLE")),
        F.concat(F.lit("v"), _random_text(41, digits, 1, 2), F.lit("."), _random_text(42, digits, 1, 2), F.lit("."), number),
    ]
    label = (_pick(50, 2) == 0).cast("double")
    keyed = _pick(51, 4) < F.when(label == 1, 3).otherwise(2)
    frame = lambda side: F.when(keyed, _one_of(52, [k[side] for k in KEYED])).otherwise(_one_of(53, [k[side] for k in NEUTRAL]))
    rows = rows.select("id", "pool", label.alias("label"), F.when(label == 1, _one_of(54, secrets)).otherwise(_one_of(55, ordinary)).alias("planted"),
                       frame(0).alias("front"), frame(1).alias("back"))
    text = F.concat(word(60), F.lit(" "), word(61), F.lit(" "), F.col("front"), F.col("planted"), F.col("back"), F.lit(" "), word(62))
    return rows.select(F.col("id").alias("doc_id"), text.alias("text"), "planted", "label")


def planted_findings(spark: SparkSession, documents: DataFrame, n: int = PLANTS) -> DataFrame:
    """The findings of the planted lines that are the planted value, with its ``label``."""
    lines = staged(planted_lines(spark, staged(word_pool(documents), "secret-pool"), n), "secret-plants")
    found = findings(lines.select("doc_id", "text"))
    known = lines.select(F.col("doc_id").alias("__id"), "planted", F.col("label").alias("truth"))
    return found.join(F.broadcast(known), (F.col("doc_id") == F.col("__id")) & (F.col("value") == F.col("planted"))).drop("__id", "planted")


def scan(documents: DataFrame, plants: int = PLANTS, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """A row per finding: ``doc_id``, ``pos``, ``token``, ``value``, the features, ``label``, ``score`` and ``secret``.

    ``label`` is what the format decides by itself (:func:`labelled`); the forest has not seen it.
    """
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    taught = planted_findings(documents.sparkSession, documents, plants)
    found = findings(documents).withColumn("truth", F.lit(None).cast("double"))
    # Planted and real findings are described together: one more pass over the corpus for the dictionary.
    found = staged(found.unionByName(taught), "secret-findings")
    rows = staged(labelled(featured(documents, found, max_broadcast)), "secret-features")
    # One partition of at most ``plants`` short rows, in a fixed order: the forest is the same each time.
    train = rows.where("truth IS NOT NULL").orderBy("doc_id", "pos", "value", "key").select(F.col("truth").alias("label"), *FEATURES)
    train = staged(train.coalesce(1), "secret-training")
    rows = rows.where("truth IS NULL")
    if train.select("label").distinct().count() < 2:
        scored = rows.withColumn("score", F.lit(0.0))
    else:
        assemble = VectorAssembler(inputCols=FEATURES, outputCol="features")
        forest = RandomForestClassifier(labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
        model = forest.fit(assemble.transform(train).coalesce(1))
        scored = model.transform(assemble.transform(rows))
        scored = scored.withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", "pos", "token", "value", *FEATURES, "label", "score",
                         (F.col("score") >= 0.5).alias("secret"))
