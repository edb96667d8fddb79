"""Registered queries ``opN_<name>`` and, where SQL can express them, their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallysheet.sources.tables import table
from tallysheet.llm import (
    chat,
    decontaminate,
    language,
    licenses,
    line_dedup,
    manifest,
    mixing,
    ngram_join,
    prefix_trie,
    quality,
    secrets,
    toxicity,
    warc,
)

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return wrap


@register("op1_decontaminate", oracle=r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), wins AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s FROM bw WHERE len(w) > 0)
), lens AS (SELECT DISTINCT n FROM wins
), dwin AS (
  SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s FROM dw, lens WHERE len(w) >= n)
), hits AS (
  SELECT DISTINCT doc_id, s, dwin.n, item_id FROM dwin JOIN wins ON dwin.win = wins.win
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM hits) GROUP BY 1
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS joined
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY 1
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(joined, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
""")
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


@register("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(documents, table(spark, sf_dir, "labels"))
    return toxicity.score(documents, model).select(
        "doc_id", toxicity.held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register("op4_line_dedup")
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), whole_runs=True)
    return done.select("row.doc_id", "n_lines", "n_gone", F.length("text").cast("long").alias("n_chars_left"),
                       F.sha2("text", 256).alias("text_sha256"))


@register("op7_ngram_join", oracle=r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '\S+') AS w FROM documents
), g AS (
  SELECT DISTINCT doc_id, array_to_string(w[s:s + 4], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS s FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING count(*) >= 0.8 * (na.n + nb.n - count(*)) - 1e-9
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), sets AS (SELECT doc_id, md5(string_agg(gram, chr(1) ORDER BY gram)) AS k FROM g GROUP BY doc_id
), copies AS (
  SELECT doc_id, min(doc_id) OVER (PARTITION BY k) AS copy_of, count(*) OVER (PARTITION BY k) AS n_copies FROM sets
)
SELECT w.doc_id, least(w.doc_id, coalesce((SELECT min(b) FROM reach WHERE a = w.doc_id), w.doc_id)) AS class_id,
       (SELECT count(*) FROM links WHERE a = w.doc_id) AS n_links, coalesce(copy_of, w.doc_id) AS copy_of,
       coalesce(n_copies, 1) AS n_copies
FROM w LEFT JOIN copies USING (doc_id)
""")
def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op8_mixing", oracle="""
WITH sizes AS (
  SELECT source, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS size FROM documents GROUP BY source
), rates AS (
  SELECT source, CASE WHEN size > 0 THEN (1.0::DOUBLE / (SELECT count(*) FROM sizes)) * (SELECT sum(size) FROM sizes)::DOUBLE / size
                      ELSE 1.0 END AS rate FROM sizes
), terms AS (
  SELECT source, rate, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p
  FROM (SELECT source, rate, unnest(generate_series(0, CAST(ceil(rate + 12 * sqrt(rate) + 20) AS BIGINT))) AS k
        FROM rates WHERE rate > 0)
), cdf AS (
  SELECT source, rate, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms
), drawn AS (
  SELECT doc_id, source, md5(text) AS text_md5, (('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13))::BIGINT + 0.5::DOUBLE)
         / 4503599627370496.0::DOUBLE AS u FROM documents
), counts AS (
  SELECT doc_id, d.source, text_md5, u, (SELECT max(rate) FROM rates r WHERE r.source IS NOT DISTINCT FROM d.source) AS rate,
         (SELECT count(*) FROM cdf WHERE cdf.source IS NOT DISTINCT FROM d.source AND cdf.c < d.u) AS times
  FROM drawn d
)
SELECT doc_id, source, text_md5, rate, CAST(copy AS INTEGER) AS copy,
       (('0x' || substr(md5('17:order:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || CAST(copy AS VARCHAR)), 1, 13))::BIGINT
        + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS order_key
FROM (SELECT doc_id, source, text_md5, rate, unnest(generate_series(1, times)) AS copy FROM counts)
""")
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(documents).select("doc_id", "source", "rate", "copy", "order_key", F.md5("text").alias("text_md5"))


@register("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = language.identify(documents, language.learn(documents))
    return found.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected")


@register("op6_quality")
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


@register("op3_chat_snapshots", oracle="""
WITH t AS (
  SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos,
         count(*) OVER (PARTITION BY conv_id) AS n_turns FROM conversations WHERE conv_id IS NOT NULL
), p AS (
  SELECT conv_id, n_turns, pos, string_agg(md5(role || chr(0) || text), ',') OVER (PARTITION BY conv_id ORDER BY pos) AS prefix
  FROM t
), whole AS (SELECT n_turns, prefix, min(conv_id) AS conv_id FROM p WHERE pos = n_turns GROUP BY 1, 2
), kept AS (
  SELECT conv_id, n_turns FROM whole
  WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.pos < p.n_turns AND p.pos = whole.n_turns AND p.prefix = whole.prefix)
)
SELECT conv_id, CAST(kept.n_turns AS BIGINT) AS n_turns, 0 AS part,
       string_agg('<|' || role || '|>' || chr(10) || replace(text, '<|', '< |') || '<|end|>' || chr(10), '' ORDER BY turn) AS text
FROM kept JOIN t USING (conv_id) GROUP BY conv_id, kept.n_turns
""")
def op3_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(table(spark, sf_dir, "conversations"))


@register("op10_warc")
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.round_trip(table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op9_secrets")
def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "pos", F.sha2("value", 256).alias("value_sha256"), *secrets.FEATURES, "label", "score",
                        "secret")


#: Unsigned crc32 of the decimal text of a number, bit by bit, as DuckDB has no function for it.
CRC32_SQL = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(range(1, length({0}::VARCHAR) + 1),
    lambda i: list_transform(range(0, 8), lambda b: ((ascii(substr({0}::VARCHAR, i, 1)) >> b) & 1)::BIGINT)))),
    lambda a, b: xor(a >> 1, CASE WHEN (xor(a, b) & 1) = 1 THEN 3988292384 ELSE 0 END)), 4294967295)"""


@register("op11_prefix_trie", oracle=f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (SELECT conv_id, {CRC32_SQL.format('conv_id')} % 6 AS h FROM t GROUP BY conv_id
), n AS (
  SELECT c.conv_id, h, count(b.pos) AS g FROM c LEFT JOIN t b ON b.conv_id = c.conv_id - c.conv_id % 100 AND b.pos <= h GROUP BY 1, 2
), r AS (
  SELECT n.conv_id, b.pos, b.role, b.text FROM n JOIN t b ON b.conv_id = n.conv_id - n.conv_id % 100 AND b.pos <= h
  UNION ALL SELECT n.conv_id, t.pos - h + g, t.role, t.text FROM n JOIN t ON t.conv_id = n.conv_id AND t.pos > h
), p AS (
  SELECT conv_id, pos AS depth, text,
         string_agg(md5(length(role) || ':' || role || text), ',') OVER (PARTITION BY conv_id ORDER BY pos) AS node FROM r
  UNION ALL SELECT conv_id, 0, '', '' FROM n
), last AS (SELECT conv_id, max(depth) AS len FROM p GROUP BY 1
), nodes AS (
  SELECT node, depth, min(p.conv_id) AS conv_id, count(*) AS n_convs, max(length(text)) AS size,
         sha256(coalesce(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) FILTER (WHERE depth = len), '')) AS ends_sha256
  FROM p JOIN last USING (conv_id) GROUP BY 1, 2
), up AS (
  SELECT nodes.*, a.node AS parent FROM nodes LEFT JOIN p a ON a.conv_id = nodes.conv_id AND a.depth = nodes.depth - 1
), kids AS (SELECT parent AS node, count(*) AS n_children FROM up WHERE parent IS NOT NULL GROUP BY 1
), full_nodes AS (SELECT up.*, coalesce(n_children, 0) AS n_children FROM up LEFT JOIN kids USING (node)
), below AS (
  SELECT a.node, sum((n_convs - 1) * size) AS saved, count(*) FILTER (WHERE n_children = 0) AS n_leaves
  FROM full_nodes d JOIN p a ON a.conv_id = d.conv_id AND a.depth <= d.depth GROUP BY 1
)
SELECT f.conv_id, f.depth, q.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens, f.ends_sha256
FROM full_nodes f JOIN below USING (node) LEFT JOIN nodes q ON q.node = f.parent
""")
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


_LEAF_SQL = "sha256({})".format(" || ".join(
    f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR END"
    for c in ("doc_id", "source", "lang", "n_chars", "{text}")))
_FAN_SQL = """SELECT {key}, lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM {name} WHERE n > 1
  GROUP BY {key}, lvl, idx // 3, n"""
_SIDES_SQL = """SELECT *, coalesce(string_agg(h, '') OVER (PARTITION BY {key}, lvl, idx // 3 ORDER BY idx
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, coalesce(string_agg(h, '') OVER (PARTITION BY {key}, lvl, idx // 3
    ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name} WHERE n > 1"""


@register("op12_merkle_manifest", oracle=f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, {_LEAF_SQL.format(text='text')} AS leaf, {_LEAF_SQL.format(text='tampered')} AS changed
  FROM (SELECT *, CASE WHEN doc_id IS NOT NULL AND {CRC32_SQL.format('doc_id')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS tampered
        FROM documents)
), placed AS (
  SELECT *, coalesce('=' || source, '') AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY source) AS total FROM leaves
), lv(tree, lvl, idx, n, h) AS (
  SELECT tree, 0, place, total, leaf FROM placed UNION ALL {_FAN_SQL.format(key='tree', name='lv')}
), subroots AS (
  SELECT tree, h AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS place, count(*) OVER () AS total FROM lv WHERE n = 1
), top(one, lvl, idx, n, h) AS (
  SELECT 1, 0, place, total, subroot FROM subroots UNION ALL {_FAN_SQL.format(key='one', name='top')}
), sides AS ({_SIDES_SQL.format(key='tree', name='lv')}
), top_sides AS ({_SIDES_SQL.format(key='one', name='top')}
), steps AS (
  SELECT placed.*, subroot, lvl, l, r FROM placed JOIN subroots USING (tree)
  JOIN sides ON sides.tree = placed.tree AND sides.idx = placed.place // CAST(pow(3, lvl) AS BIGINT)
  UNION ALL SELECT placed.*, subroot, 1000 + lvl, l, r FROM placed JOIN subroots USING (tree)
  JOIN top_sides ON top_sides.idx = subroots.place // CAST(pow(3, lvl) AS BIGINT)
), paths AS (
  SELECT tree, place, string_agg(l || r, '' ORDER BY lvl) AS proof, list(l || '|' || r ORDER BY lvl) AS path FROM steps GROUP BY 1, 2
), done AS (
  SELECT doc_id, leaf, subroot, (SELECT h FROM top WHERE n = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
         list_reduce(list_concat([changed], coalesce(path, [])),
                     lambda a, x: sha256(split_part(x, '|', 1) || a || split_part(x, '|', 2))) AS folded_root
  FROM placed JOIN subroots USING (tree) LEFT JOIN paths ON paths.tree = placed.tree AND paths.place = placed.place
)
SELECT *, folded_root = root AS verified FROM done
""")
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(table(spark, sf_dir, "documents"), manifest.without_line_feeds())


def _license_oracle() -> str:
    """All pairs of a block and a notice, verified on their sets."""
    def quoted(words) -> str:
        return "[" + ", ".join(f"'{w}'" for w in words) + "]"

    known = licenses.Notices(licenses.NOTICES, licenses.THRESHOLD)
    notices = ", ".join(
        f"('{label}', {quoted(sorted(set(licenses.words_of(text))))}, '{' '.join(licenses.words_of(name))}', {need - 1})"
        for (label, text, name), need in zip(licenses.NOTICES, known.need))
    phrases = ", ".join(f"({quoted(licenses.words_of(p))}, '{label}')" for p, label in licenses.PHRASES.items())
    names = quoted(sorted({" ".join(licenses.words_of(name)) for _, _, name in licenses.NOTICES}))
    vocabulary = quoted(sorted(known.number))
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), ph(words, label) AS (VALUES {phrases}
), notices(label, words, name, need) AS (VALUES {notices}
), spoken AS (SELECT row, unnest(w) AS word, unnest(range(0, len(w))) AS pos FROM d
), starts AS (
  SELECT d.row, pos, label FROM spoken JOIN d USING (row) JOIN ph ON word = ph.words[1] AND w[pos + 1:pos + len(ph.words)] = ph.words
), base AS (
  SELECT row, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list_sort(list(DISTINCT label)) AS base_labels
  FROM starts GROUP BY row
), places AS (
  SELECT row, pos, word FROM spoken WHERE word IN (SELECT unnest({vocabulary}))
  UNION ALL SELECT spoken.row, spoken.pos, n.name FROM spoken JOIN d USING (row)
  JOIN (SELECT DISTINCT name, string_split(name, ' ') AS words FROM notices) n
    ON word = n.words[1] AND w[pos + 1:pos + len(n.words)] = n.words AND len(n.words) > 1
), blocks AS (
  SELECT row, block, list(DISTINCT word) AS held
  FROM (SELECT row, word, unnest([pos // {known.longest}, pos // {known.longest} - 1]) AS block FROM places)
  WHERE block >= 0 GROUP BY row, block
), found AS (
  SELECT row, label, len(list_intersect(held, words)) / len(words) AS part FROM blocks JOIN notices
    ON list_contains(held, name) AND len(list_intersect(held, words)) >= need
), more AS (SELECT row, list(DISTINCT label) AS labels, max(part) AS best FROM found GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(base_labels, ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base_labels, []), coalesce(labels, [])))), ',') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score
FROM d LEFT JOIN base USING (row) LEFT JOIN more USING (row)
"""


@register("op13_license_scan", oracle=_license_oracle())
def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))
