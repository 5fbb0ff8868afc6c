"""One query per operator, over its whole table, with the SQL that must agree where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commentlens.llm import chat_format, content_sort, dimension_scan, divergence, hashed_maxent, language_id, line_index, merkle
from commentlens.llm import mixing, packing, relative_parse, simhash, suffix_runs
from commentlens.llm.common import remainder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_hashed_maxent")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    held_out = remainder("doc_id", 7) == 2
    found = hashed_maxent.score(docs, hashed_maxent.train(docs.filter(~held_out)))
    columns = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return found.withColumnRenamed("key", "doc_id").select("doc_id", held_out.alias("held_out"), *columns)


@query(
    "op2_relative_parse",
    r"""
WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, greatest(len(words) - 18, 1))) AS s,
    unnest(list_transform(range(1, greatest(len(words) - 18, 1)), lambda i: array_to_string(list_slice(words, i, i + 19), ' '))) AS w
  FROM split),
later AS (SELECT doc_id, s FROM windows QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, s) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM later),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM split) ANTI JOIN gone USING (doc_id, i)
  GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)""",
)
def op2(spark: SparkSession, sf: str) -> DataFrame:
    parsed = relative_parse.remove_repeats(documents(spark, sf))
    return parsed.select(F.col("key").alias("doc_id"), "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op3_dimension_scan")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return dimension_scan.nearest(spark.read.parquet(f"{sf}/embeddings.parquet"), "vec_id % 50 = 0")


@query("op4_packing")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(documents(spark, sf), tokenizer_file())


@query("op5_language_id")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    trees = language_id.learn(docs.filter(remainder("doc_id", 3) != 1))
    held_out = (remainder("doc_id", 3) == 1).alias("held_out")
    return language_id.predict(docs, trees, carry=[F.col("doc_id"), held_out])


@query("op6_simhash")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_copies(documents(spark, sf))
    return found.select(
        F.col("key").alias("doc_id"), simhash.to_hex("fp").alias("fingerprint"), F.col("component").alias("component_id")
    )


@query(
    "op7_content_sort",
    r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  row_number() OVER (PARTITION BY norm ORDER BY doc_id) = 1 AS kept, sha256(norm) AS text_sha256
FROM n""",
)
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return content_sort.sort_by_content(documents(spark, sf), keep=["doc_id"])


@query(
    "op8_chat_format",
    r"""
WITH rows AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, length(role) + length(text) + 10
    + len(regexp_extract_all(text, '[<\[|]\\*(?:/s>|s>|/?INST\]|>)')) + len(regexp_extract_all(text, '[<\[|]\\*\|')) AS chars
  FROM rows)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id""",
)
def op8(spark: SparkSession, sf: str) -> DataFrame:
    text = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string"
    )
    rows = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    turns = chat_format.from_table(rows.unionByName(extra), "conv_id")
    return chat_format.read_back(chat_format.format_turns(turns)).withColumnRenamed("key", "conv_id")


@query(
    "op9_suffix_runs",
    r"""
WITH split AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents),
places AS (SELECT doc_id, x, n, unnest(range(0, greatest(n - 99, 0), 500)) AS c FROM split),
chunks AS (SELECT doc_id, c, substr(x, 2 * c + 1, 1198) AS y, least(500, n - 99 - c) AS m FROM places),
windows AS (
  SELECT doc_id, c + unnest(range(0, m)) AS s, unnest(list_transform(range(0, m), lambda i: md5_number(substr(y, 2 * i + 1, 200)))) AS w
  FROM chunks),
later AS (SELECT doc_id, s FROM windows QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, s) > 1),
reach AS (SELECT doc_id, s, max(s + 100) OVER (PARTITION BY doc_id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS e FROM later),
runs AS (SELECT doc_id, s, sum(CASE WHEN e >= s THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY s) AS r FROM reach),
spans AS (SELECT doc_id, r, min(s) AS a, max(s) + 100 AS b FROM runs GROUP BY doc_id, r),
gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b, b - a AS gone FROM spans),
pieces AS (
  SELECT doc_id, string_agg(substr(x, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS head, max(b + gone) AS e, sum(gone) AS gone, count(*) AS k
  FROM gaps JOIN split USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(k, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(e, 0) + 1))) AS kept_sha256
FROM split LEFT JOIN pieces USING (doc_id)""",
)
def op9(spark: SparkSession, sf: str) -> DataFrame:
    cut = suffix_runs.remove_repeats(documents(spark, sf))
    return cut.select(
        F.col("key").alias("doc_id"),
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query(
    "op10_poisson_mix",
    """
WITH RECURSIVE volumes AS (
  SELECT coalesce(source, chr(0) || 'missing') AS s, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS volume FROM documents GROUP BY 1),
weighed AS (SELECT *, CASE WHEN volume > 0 THEN pow(CAST(volume AS DOUBLE), 0.5) ELSE 0.0 END AS weight FROM volumes),
rates AS (
  SELECT s, CASE WHEN volume > 0 THEN 1.0::DOUBLE * (weight / (SELECT sum(weight) FROM weighed))
    * CAST((SELECT sum(volume) FROM weighed) AS DOUBLE) / volume ELSE 1.0 END AS rate FROM weighed),
steps(s, mean, k, p, cdf) AS (
  SELECT s, rate, 0, exp(-rate), exp(-rate) FROM rates
  UNION ALL
  SELECT s, mean, k + 1, p * mean / (k + 1), cdf + p * mean / (k + 1) FROM steps WHERE k < ceil(mean + 12 * sqrt(mean) + 40)),
counted AS (
  SELECT d.*, r.rate, (SELECT count(*) FROM steps t WHERE t.s = r.s AND t.cdf <
    (CAST(('0x' || substr(md5(concat('mix:', d.doc_id)), 1, 13)) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE) AS n
  FROM documents d JOIN rates r ON r.s = coalesce(d.source, chr(0) || 'missing'))
SELECT doc_id, text, lang, source, n_chars, round(rate, 9) AS rate, CAST(copy AS INTEGER) AS copy,
  md5(concat('mix:order:', doc_id, ':', copy)) AS shuffle_key
FROM (SELECT *, unnest(range(1, n + 1)) AS copy FROM counted)""",
)
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(documents(spark, sf)).withColumn("rate", F.round("rate", 9))


@query(
    "op11_merkle_manifest",
    """
WITH RECURSIVE parts AS (
  SELECT *, replace(text, chr(10), '') AS cut, coalesce('=' || source, '') AS s,
    coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-')
    || coalesce(octet_length(encode(source)) || ':' || source, '-') || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
    || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS head
  FROM documents),
leaves AS (
  SELECT doc_id, s, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(octet_length(encode(cut)) || ':' || cut, '-')) AS cut_leaf
  FROM parts),
low(l, s, pos, n, h) AS (
  SELECT 0, s, row_number() OVER (PARTITION BY s ORDER BY doc_id) - 1, count(*) OVER (PARTITION BY s), leaf FROM leaves
  UNION ALL
  SELECT l + 1, s, pos // 3, max((n + 2) // 3), sha256(string_agg(h, '' ORDER BY pos)) FROM low WHERE n > 1 GROUP BY l, s, pos // 3),
top(l, pos, n, h) AS (
  SELECT 0, row_number() OVER (ORDER BY s) - 1, count(*) OVER (), h FROM low WHERE n = 1
  UNION ALL
  SELECT l + 1, pos // 3, max((n + 2) // 3), sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY l, pos // 3),
nodes AS (
  SELECT 0 AS tree, l, s, pos, h FROM low WHERE n > 1
  UNION ALL SELECT 1, l, '', pos, h FROM top WHERE n > 1),
edges AS (
  SELECT tree, l, s, pos,
    coalesce(string_agg(h, '' ) OVER (w ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(h, '' ) OVER (w ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM nodes WINDOW w AS (PARTITION BY tree, l, s, pos // 3)),
placed AS (
  SELECT doc_id, s, leaf, CASE WHEN crc32_even THEN cut_leaf ELSE leaf END AS given,
    row_number() OVER (PARTITION BY s ORDER BY doc_id) - 1 AS pos
  FROM (SELECT *, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
      lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(i AS INTEGER), 1)) AS BIGINT))), lambda c, x: xor(c >> 8,
        list_reduce(list_prepend(xor(c, x) & 255, range(8)), lambda t, k: CASE WHEN t & 1 = 1 THEN xor(t >> 1, 3988292384) ELSE t >> 1 END)))
      % 2 = 1 AS crc32_even
    FROM leaves)),
sources AS (SELECT s, h AS subroot, row_number() OVER (ORDER BY s) - 1 AS place FROM low WHERE n = 1),
walk(doc_id, tree, l, s, pos, place, h, proof) AS (
  SELECT doc_id, 0, 0, placed.s, pos, place, given, '' FROM placed JOIN sources USING (s)
  UNION ALL
  SELECT * FROM (
    SELECT w.doc_id, w.tree, w.l + 1, w.s, w.pos // 3, w.place, sha256(e.before || w.h || e.after), w.proof || e.before || e.after
    FROM walk w JOIN edges e ON e.tree = w.tree AND e.l = w.l AND e.s = w.s AND e.pos = w.pos
    UNION ALL
    SELECT w.doc_id, 1, 0, '', w.place, w.place, w.h, w.proof FROM walk w
    WHERE w.tree = 0 AND NOT EXISTS (SELECT 1 FROM edges e WHERE e.tree = 0 AND e.l = w.l AND e.s = w.s AND e.pos = w.pos))),
done AS (SELECT doc_id, h, proof FROM walk WHERE tree = 1 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY l DESC) = 1),
root AS (SELECT h AS root FROM top WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, done.h AS folded_root, done.h = root AS verified
FROM placed JOIN sources USING (s) JOIN done USING (doc_id), root""",
)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    cut = merkle.leaf_digest(*columns, F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    tampered = F.when(remainder("doc_id", 2) == 0, cut)
    made = merkle.build(documents(spark, sf), carry={"doc_id": F.col("doc_id"), "tampered": tampered})
    given = made.rows.withColumn("given", F.coalesce("tampered", "leaf")).drop("tampered")
    found = merkle.verify(merkle.Manifest(given, made.root), "given")
    return found.select(
        "doc_id", merkle.hex_text("leaf").alias("leaf"), merkle.hex_text("subroot").alias("subroot"), "root", "proof_sha256", "folded_root", "verified"
    )


@query(
    "op12_line_index",
    r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
gone AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT doc_id, line, i, key IN (SELECT key FROM gone) AS dropped FROM keyed)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    found = line_index.drop_repeated_lines(documents(spark, sf), carry=["doc_id"])
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query(
    "op13_source_divergence",
    r"""
WITH texts AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
places AS (SELECT lang, source, doc_id, unnest(words) AS term FROM texts),
kept AS (
  SELECT lang, term, CAST(count(*) AS HUGEINT) AS lang_n, row_number() OVER (PARTITION BY lang ORDER BY term) AS i
  FROM places GROUP BY lang, term HAVING count(DISTINCT doc_id) >= 10),
langs AS (SELECT lang, sum(lang_n)::HUGEINT AS lang_total, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM texts),
counted AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM places GROUP BY ALL),
cells AS (SELECT g.lang, g.source, k.term, lang_n, coalesce(n, 0)::HUGEINT AS n
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
shared AS (
  SELECT lang, source, term, n, 1 + 1000000000 * (n + 2) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p,
    1 + 1000000000 * (lang_n + 2) // (lang_total + 2 * v) AS q
  FROM cells JOIN langs USING (lang)),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shared a JOIN shared b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value FROM shared WHERE n > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
QUALIFY part = 'pair' OR row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) <= 10""",
)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.audit(documents(spark, sf))
