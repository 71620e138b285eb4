"""The registered queries of the corpus operators, and the SQL that checks them."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, jaccard, licenses, lm, media, merkle, mixing, pagetext, resample, topk, toxicity, wordpiece
from .shared import read


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts imitate control strings, formatted and read back from the output."""
    hostile = spark.sql(
        "SELECT -7L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(hostile)
    # every text comes in two parts; a user's has an image, a sound and a document between them
    half = F.floor(F.length("text") / 2).cast("int")
    fields = dict(x.split(":") for x in chat.PART[7:-1].split(","))
    part = lambda **own: F.struct(*[own.get(n, F.lit(None)).cast(t).alias(n) for n, t in fields.items()])
    ref = F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    halves = part(type=F.lit("text"), text=F.left("text", half)), part(type=F.lit("text"), text=F.substr("text", half + 1))
    between = part(type=F.lit("image"), ref=ref, width=F.lit(28), height=F.lit(20)), part(type=F.lit("audio"), ref=ref, seconds=F.lit(1.5)), part(type=F.lit("document"), ref=ref, pages=F.lit(2))
    content = F.when(F.col("role") == "user", F.array(halves[0], *between, halves[1])).otherwise(F.array(*halves))
    out = chat.format_chat(rows.select("conv_id", "turn", "role", content.alias("content")))
    back = chat.parse_chat(F.col("formatted"), placeholders=False)
    loss = chat.masked_text(F.col("formatted"), F.col("loss_spans"))
    return out.select(
        "conv_id", F.size(back).cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform(back, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), F.size("attachments").cast("long").alias("n_attachments"), "expanded_tokens",
    )


_CONTROL = r"([<\[])(\\*)(\|[a-z_]+\|>|/?s>|/?INST\]|</?SYS>>)"

OP1_SQL = rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, turn, role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS t(turn, role)),
marked AS (
  SELECT *, length(regexp_replace(role, '{_CONTROL}', '\1\\\2\3', 'g')) + 23 + CASE WHEN role = 'user'
      THEN length(regexp_replace(left(text, length(text) // 2), '{_CONTROL}', '\1\\\2\3', 'g')) + 30 + length(regexp_replace(text[length(text) // 2 + 1:], '{_CONTROL}', '\1\\\2\3', 'g'))
      ELSE length(regexp_replace(text, '{_CONTROL}', '\1\\\2\3', 'g')) END AS n FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  length(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), ''))::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(n)::BIGINT AS formatted_chars, 3 * count(*) FILTER (role = 'user') AS n_attachments, (count(*) FILTER (role = 'user') * (4 + 38 + 512))::BIGINT AS expanded_tokens
FROM marked GROUP BY conv_id
"""


def tokenizer_file(name: str) -> str:
    """Path of a public vocabulary file; jobs that have none of these can still use the other queries."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded to ids and decoded again."""
    path = tokenizer_file("word_bpe_49k.json")
    done = bpe.encode(read(spark, sf_dir, "documents").select("doc_id", "text"), path, decoded="decoded")
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), bpe.ids_digest("ids").alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word-piece counts of every whole text over a public vocabulary of 50,256 byte strings."""
    return wordpiece.count_tokens(read(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_file("byte_bpe_50k.tiktoken"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents by 3-word shingles at a Jaccard similarity of 0.9."""
    return jaccard.jaccard_components(read(spark, sf_dir, "documents"), words=3, percent=90)


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best rows for every vector whose vec_id is divisible by 50."""
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP5_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT vec_id AS query_id, unnest(e) AS x, generate_subscripts(e, 1) AS i, len(e) AS n FROM v WHERE vec_id % 50 = 0),
c AS (SELECT vec_id, unnest(e) AS x, generate_subscripts(e, 1) AS i, len(e) AS n FROM v),
s AS (SELECT query_id, vec_id, sum(q.x * c.x)::BIGINT AS score FROM q JOIN c USING (i, n) WHERE vec_id <> query_id GROUP BY ALL)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""


def op6_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text stored as 8-bit samples, declared by chance, sniffed, read back, and what it embeds carved out."""
    held = media.store_payload(read(spark, sf_dir, "documents").select("doc_id", "text"))
    got = media.sniff_media(held, carve=True)
    return got.select(
        "doc_id", "n_bytes", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -64, 64)).alias("tail_crc32"), F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.concat_ws(";", "true_type", F.when(F.col("true_type") != F.col("declared_type"), F.concat(F.lit("corrected="), "declared_type")), F.concat(F.lit("embedded="), F.size("embedded").cast("string")),
                    F.concat(F.lit("carved="), F.sha2(F.concat(F.lit(b""), F.array_join(F.transform("embedded", lambda e: F.hex(e["bytes"])), "").cast("binary")), 256))).alias("feature"),
    )


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as files of a tree source/lang/doc_id.txt."""
    parts = [F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("und")), F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))]
    return licenses.scan_licenses(read(spark, sf_dir, "documents").select(F.concat_ws("/", *parts).alias("path"), "text"))


_TEMPLATE_ROWS = ", ".join(f"({i}, '{n}', '{t.replace(chr(39), chr(39) * 2)}')" for i, (n, t) in enumerate(licenses.TEMPLATES))
_TERMS = r"regexp_extract_all(lower({}), '[a-z0-9](?:[a-z0-9.-]*[a-z0-9])?')"

OP7_SQL = rf"""
WITH t AS (SELECT template, license, {_TERMS.format("text")} AS words FROM (VALUES {_TEMPLATE_ROWS}) AS v(template, license, text)),
f AS (SELECT concat_ws('/', coalesce(source, 'unknown'), coalesce(lang, 'und'), doc_id || '.txt') AS path, text FROM documents),
voc AS (SELECT DISTINCT unnest(words) AS term FROM t),
has AS (SELECT path, unnest(list_distinct({_TERMS.format("text")})) AS term FROM f),
spread AS (SELECT term, count(*) AS df FROM has JOIN voc USING (term) GROUP BY term),
idf AS (SELECT term, ln((1 + (SELECT count(*) FROM f))::DOUBLE / (1 + coalesce(df, 0))) + 1 AS idf FROM voc LEFT JOIN spread USING (term)),
tw AS (SELECT template, license, term, count(*) * any_value(idf) AS w FROM (SELECT template, license, unnest(words) AS term FROM t) JOIN idf USING (term) GROUP BY ALL),
pattern AS (SELECT *, w / sqrt(sum(w * w) OVER (PARTITION BY template)) AS p FROM tw),
split AS (SELECT path, text, string_split(text, chr(10)) AS al FROM f),
lines AS (SELECT path, text, list_distinct(flatten(list_transform(list_filter(generate_series(1, len(al)), lambda i: regexp_matches(lower(al[i]), '{licenses.MARKS}')), lambda i: [al[i], array_to_string(al[i:i + {licenses.WRAP - 1}], ' ')]))) AS ls FROM split),
passages AS (SELECT path, generate_subscripts(ls, 1) AS no, unnest(ls) AS part FROM lines WHERE len(ls) > 0 UNION ALL SELECT path, 0, text FROM lines WHERE len(ls) > 0),
pw AS (SELECT path, no, term, count(*) * coalesce(any_value(idf), ln((1 + (SELECT count(*) FROM f))::DOUBLE) + 1) AS w FROM (SELECT path, no, unnest({_TERMS.format("part")}) AS term FROM passages) LEFT JOIN idf USING (term) GROUP BY path, no, term),
norms AS (SELECT path, no, sqrt(sum(w * w)) AS norm FROM pw GROUP BY ALL),
cosines AS (SELECT path, no, template, license, round(sum(pw.w * p) / any_value(norm), 6) AS score FROM pw JOIN pattern USING (term) JOIN norms USING (path, no) GROUP BY ALL),
hits AS (SELECT * FROM cosines WHERE score >= CASE WHEN no = 0 THEN {licenses.FILE} ELSE {licenses.HEADER} END),
own AS (SELECT path, arg_max(license, (score, -template)) AS license, max(score) AS score FROM hits GROUP BY path),
files AS (SELECT path, license, score, template FROM hits WHERE no = 0 QUALIFY row_number() OVER (PARTITION BY path ORDER BY score DESC, template) = 1),
holders AS (SELECT regexp_extract(path, '^(.*)/[^/]*$', 1) AS source, arg_min(license, (-score, template, path)) AS inherited FROM files GROUP BY ALL),
folders AS (SELECT DISTINCT regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder FROM f),
above AS (SELECT folder, unnest(list_transform(generate_series(0, len(string_split(folder, '/'))), lambda k: {{'depth': k, 'source': array_to_string(string_split(folder, '/')[1:k], '/')}}), recursive := true) FROM folders),
given AS (SELECT folder, arg_max(inherited, depth) AS inherited, arg_max(source, depth) AS source FROM above JOIN holders USING (source) GROUP BY folder)
SELECT f.path, coalesce(own.license, inherited) AS license, own.score, CASE WHEN own.license IS NOT NULL THEN 'own' WHEN inherited IS NOT NULL THEN 'inherited' ELSE 'none' END AS how,
  CASE WHEN own.license IS NULL THEN source END AS source
FROM f LEFT JOIN own USING (path) LEFT JOIN given ON folder = regexp_extract(f.path, '^(.*)/[^/]*$', 1)
"""


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed 5 : 2 : 1 by source to 150 % of all words."""
    return mixing.mix_sources(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All whole texts scored by counts and by the mixed model, both learnt from nine tenths of the documents."""
    return lm.score_texts(read(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text scored by its nearest labelled examples."""
    return toxicity.score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted", "evidence")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, roots and proofs of all documents, and what becomes of the root if a third of the texts are lower-cased."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = read(spark, sf_dir, "documents").select(*fields)
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    altered = F.when(third, merkle.leaf_of(*[lowered if c == "text" else F.col(c) for c in fields]))
    out = merkle.manifest(docs, fields, "lang", "doc_id", altered=altered)
    folded = merkle.fold(F.coalesce("altered", "leaf"), F.col("path"))
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof_text(F.col("path")), 256).alias("proof_sha256"), folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def crc32_sql(text: str) -> str:
    """DuckDB SQL for the unsigned crc32 of a text's UTF-8 bytes, bit by bit (the polynomial 0xEDB88320 is a fixed value)."""
    octets = f"list_transform(range(0, octet_length(encode({text})), 1), lambda i: ('0x' || substr(hex(encode({text})), 2 * i::INT + 1, 2))::BIGINT)"
    step = "list_reduce(range(0, 8), lambda r, _: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END, xor(c, b))"
    return f"xor(list_reduce({octets}, lambda c, b: {step}, 4294967295), 4294967295)"


def _leaf_sql(text: str) -> str:
    fields = ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({c}))::VARCHAR || ':' || {c}, '-')" for c in fields) + ")"


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WALK = """
{0}_tree AS (
  SELECT tree, 0 AS level, pos AS idx, h, n FROM {0}_leaves
  UNION ALL SELECT tree, level + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), any_value(n) FROM {0}_tree WHERE n > 8 ** level GROUP BY tree, level, idx // 8),
{0}_sides AS (
  SELECT tree, level, idx, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {0}_tree WHERE n > 8 ** level WINDOW w AS (PARTITION BY tree, level, idx // 8 ORDER BY idx))"""
_CLIMB = """
{0}_climb AS (
  SELECT doc_id, tree, 0 AS level, pos AS idx, n, {1} AS fold, {2} AS proof FROM {3}
  UNION ALL SELECT doc_id, c.tree, c.level + 1, c.idx // 8, n, sha256(l || fold || r), proof || l || r FROM {0}_climb c JOIN {0}_sides s ON c.tree = s.tree AND c.level = s.level AND c.idx = s.idx)"""

OP11_SQL = f"""
WITH RECURSIVE lang_leaves AS (
  SELECT doc_id, coalesce(lang, '') || (lang IS NULL) AS tree, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos, {_leaf_sql("text")} AS h,
    CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 3 = 0 THEN {_leaf_sql(_LOWER.format("text"))} END AS altered, count(*) OVER (PARTITION BY lang) AS n FROM documents),
{_WALK.format("lang")},
subroots AS (SELECT tree, h FROM lang_tree WHERE n <= 8 ** level),
top_leaves AS (SELECT '' AS tree, subroots.tree AS lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM subroots JOIN (SELECT DISTINCT tree, lang FROM lang_leaves) USING (tree)),
{_WALK.format("top")},
roots AS (SELECT h AS root FROM top_tree WHERE n <= 8 ** level),
{_CLIMB.format("lang", "coalesce(altered, h)", "''", "lang_leaves")},
half AS (SELECT doc_id, c.tree AS lang, fold, proof FROM lang_climb c WHERE n <= 8 ** level),
whole AS (SELECT doc_id, t.tree, pos, n, fold AS f, proof AS p, h AS subroot FROM half JOIN top_leaves t USING (lang)),
{_CLIMB.format("top", "f", "p", "whole")}
SELECT doc_id, lang_leaves.h AS leaf, subroots.h AS subroot, root, sha256(c.proof) AS proof_sha256, c.fold AS folded_root, c.fold = root AS verified
FROM top_climb c JOIN lang_leaves USING (doc_id) JOIN subroots ON subroots.tree = lang_leaves.tree, roots WHERE c.n <= 8 ** c.level
"""


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents with 20 words, drawn by their words' shares in the benchmark's texts and in all documents."""
    drawn = resample.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


_RESAMPLE_WORDS = r"regexp_extract_all({}, '[^\x{{00}}-\x{{2F}}\x{{3A}}-\x{{60}}\x{{7B}}-\x{{7F}}]+')".format(_LOWER.format("coalesce(text, '')"))

OP12_SQL = rf"""
WITH d AS (SELECT doc_id, {_RESAMPLE_WORDS} AS ws FROM documents),
b AS (SELECT unnest({_RESAMPLE_WORDS}) AS w FROM benchmark),
e AS (SELECT doc_id, unnest(ws) AS w FROM d),
voc AS (SELECT w, {crc32_sql("w")} % 10000 AS bucket FROM (SELECT w FROM e UNION SELECT w FROM b)),
s AS (SELECT bucket, count(*) AS s FROM e JOIN voc USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM b JOIN voc USING (w) GROUP BY bucket),
gain AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT sum(s) FROM s) + 10000)::DOUBLE / ((coalesce(s, 0) + 1)::DOUBLE * (coalesce((SELECT sum(t) FROM t), 0) + 10000)::DOUBLE)))::BIGINT AS gain FROM s FULL JOIN t USING (bucket)),
weights AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM e JOIN voc USING (w) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM d LEFT JOIN weights USING (doc_id)),
drawn AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT count(*) * 10 // 100 FROM drawn) THEN rank END::BIGINT AS rank FROM scored LEFT JOIN drawn USING (doc_id)
"""


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every whole page."""
    return pagetext.extract_text(read(spark, sf_dir, "pages").select("page_id", "url", "html"))


# In the given pages the article is what the one element of this name holds, so that SQL can cut it out; blocks end at its tags.
OP13_SQL = r"""
WITH cut AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's') AS inner_html FROM pages),
blocks AS (SELECT page_id, url, string_split_regex(replace(regexp_replace(inner_html, '</?b>', '', 'g'), '<br>', ' '), '</?(?:h1|p)>') AS bs FROM cut),
decoded AS (
  SELECT page_id, url, list_filter(list_transform(bs, lambda b: trim(regexp_replace(
    regexp_replace(replace(replace(replace(replace(b, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)), '&amp;?', '&', 'g'), '[\s\x{a0}]+', ' ', 'g'))), lambda b: b <> '') AS bs FROM blocks)
SELECT page_id, url, array_to_string(bs, chr(10)) AS text, length(array_to_string(bs, chr(10)))::BIGINT AS n_chars FROM decoded
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_bpe": op2_bpe,
    "op3_token_counts": op3_token_counts,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_topk_search": op5_topk_search,
    "op6_media": op6_media,
    "op7_licenses": op7_licenses,
    "op8_mixing": op8_mixing,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_toxicity": op10_toxicity,
    "op11_merkle": op11_merkle,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_html_extraction": op13_html_extraction,
}
ORACLE_SQL: dict[str, str] = {"op1_chat_formatting": OP1_SQL, "op5_topk_search": OP5_SQL, "op7_licenses": OP7_SQL, "op11_merkle": OP11_SQL, "op12_importance_resampling": OP12_SQL, "op13_html_extraction": OP13_SQL}
