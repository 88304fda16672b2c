"""One query per operator over its whole table, with comparison SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.chat_format import chat_digests, format_chats
from tallyloom.llm.embedding_dedup import dedup_embeddings
from tallyloom.llm.jaccard_join import jaccard_components
from tallyloom.llm.lexical_search import search
from tallyloom.llm.line_dedup import dedup_lines
from tallyloom.llm.main_text import extract_text
from tallyloom.llm.mixing import mix_sources, word_count
from tallyloom.llm.pieces import piece_digests
from tallyloom.llm.quality_model import fit_quality, held_out, score_quality
from tallyloom.llm.quality_rules import judge_quality
from tallyloom.llm.secrets import KINDS, REACH, scan_secrets, span_text
from tallyloom.llm.session import prepare
from tallyloom.llm.token_files import read_token_files, write_token_files
from tallyloom.llm.vector_codes import compress_vectors
from tallyloom.runtime import materialise, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def tokenizer_file(name: str) -> bytes:
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_bytes()


def piece_model() -> bytes:
    return tokenizer_file("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op1_embedding_dedup",
    """
    WITH RECURSIVE vectors AS (
        SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    ), usable AS (
        SELECT * FROM vectors WHERE label IS NOT NULL AND e IS NOT NULL
            AND list_aggregate(e, 'count') = len(e) AND isfinite(list_dot_product(e, e)) AND list_dot_product(e, e) > 0
    ), links AS MATERIALIZED (
        SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
        WHERE list_cosine_similarity(a.e, b.e) >= 0.93
    ), reach AS (
        SELECT vec_id AS a, vec_id AS b FROM vectors
        UNION
        SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
    ), component AS (
        SELECT a, min(b) AS component_id FROM reach GROUP BY a
    ), counted AS (
        SELECT a, count(*) AS n FROM links GROUP BY a
    )
    SELECT v.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, v.vec_id = component_id AS kept
    FROM vectors v JOIN component c ON v.vec_id = c.a LEFT JOIN counted n ON v.vec_id = n.a
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_embeddings(table(spark, sf_dir, "embeddings"))


@query("op2_quality_classifier")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL: a fitted model. Tests hold it against held-out labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op3_ngram_jaccard_join")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL: a self-join on shingles is too slow over whole tables. Tests hold it against brute force."""
    return jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op4_html_extraction")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL: a tree of markup. Tests hold it against known articles."""
    read = extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return read.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op5_quality_rules")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL: the verdict rests on the longest repeat. The base columns are also compared with SQL in tests."""
    judged = judge_quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "quality.*")


def _secret_sql() -> str:
    """Positions from the text split at a pattern, then the interval join as a plain self-join."""
    found, quote = [], "''"
    for place, k in enumerate(KINDS):
        p = k.pattern.replace("'", quote)
        also = "".join(f" AND regexp_matches(m, '{a}')" for a in k.also)
        found.append(f"""
        SELECT doc_id, '{k.name}' AS kind, {place} AS place, '{k.part}' AS part, {k.base} AS base, stop - length(m) AS start_, stop AS end_ FROM (
            SELECT doc_id, m, v, sum(length(b) + length(m)) OVER (PARTITION BY doc_id ORDER BY pos) AS stop FROM (
                SELECT doc_id, unnest(ms) AS m, unnest(vs) AS v, unnest(bs[1:len(ms)]) AS b, unnest(range(len(ms))) AS pos FROM (
                    SELECT doc_id, regexp_extract_all(text, '{p}') AS ms, regexp_extract_all(text, '{p}', {k.group}) AS vs, string_split_regex(text, '{p}') AS bs
                    FROM documents WHERE regexp_matches(text, '{p}')
                )
            )
        ) WHERE length(v) >= {k.least}{also}""")
    return f"""
    WITH spans AS ({" UNION ALL ".join(found)}
    ), judged AS (
        SELECT w.doc_id, w.kind, w.place, w.part, w.start_, w.end_,
            bool_or(o.part = 'id' AND NOT (o.start_ < w.end_ AND w.start_ < o.end_)) AS near_id,
            bool_or(o.part = 'secret' AND NOT (o.start_ < w.end_ AND w.start_ < o.end_)) AS near_secret,
            bool_or(o.base AND o.start_ < w.end_ AND w.start_ < o.end_) AS covered
        FROM spans w JOIN spans o ON w.doc_id = o.doc_id AND NOT w.base AND o.start_ - w.end_ <= {REACH} AND w.start_ - o.end_ <= {REACH}
        GROUP BY ALL
    ), reported AS (
        SELECT doc_id, kind, place, base, start_, end_ FROM spans WHERE base
        UNION ALL
        SELECT doc_id, kind, place, FALSE, start_, end_ FROM judged
        WHERE NOT covered AND CASE part WHEN 'id' THEN near_secret WHEN 'secret' THEN near_id ELSE near_id AND near_secret END
    ), listed AS (
        SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
            string_agg(kind || ':' || start_ || ':' || end_, ',' ORDER BY start_, place) FILTER (base) AS base_spans,
            string_agg(kind || ':' || start_ || ':' || end_, ',' ORDER BY start_, place) AS spans
        FROM reported GROUP BY doc_id
    )
    SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
        sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(l.spans, '') AS spans
    FROM documents d LEFT JOIN listed l ON d.doc_id = l.doc_id
    """


@query("op6_secret_scan", _secret_sql())
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    counts = [count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("secrets")).alias("spans"))


@query("op7_sentencepiece")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL: piece segmentation. Tests hold it against the library and an exact round trip."""
    return piece_digests(table(spark, sf_dir, "documents").select("doc_id", "text"), piece_model())


@query(
    "op8_source_mixing",
    r"""
    WITH sized AS (
        SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
    ), sums AS (
        SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS place FROM sized GROUP BY source
    ), weighed AS (
        SELECT *, 1 + (place - 1) % 3 AS weight, 3 * source_size / (1 + (place - 1) % 3) AS cut_at FROM sums
    ), levels AS (
        SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY cut_at, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cut_at, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed
    ), targets AS (
        SELECT source, source_size, least((3 * source_size)::DOUBLE, (weight * max(level) OVER ())::DOUBLE) AS target FROM levels
    ), drawn AS (
        SELECT s.doc_id, s.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
            ('0x' || substr(md5(coalesce(CAST(s.doc_id AS VARCHAR) || ':', '') || '8'), 1, 12))::BIGINT / 281474976710656.0 AS draw
        FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
    )
    SELECT doc_id, size, source_size, target, CAST((floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken FROM drawn
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words are counted once; the mix is planned on the narrow rows."""
    counted = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("n"))
    mixed = mix_sources(materialise(counted, "counted"), size="n")
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query(
    "op9_line_dedup",
    r"""
    WITH split AS (
        SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
    ), lines AS (
        SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS place FROM split
    ), keyed AS (
        SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
    ), owners AS (
        SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key
    ), marked AS (
        SELECT k.doc_id, k.line, k.place, coalesce(o.owner < k.doc_id, FALSE) AS gone FROM keyed k LEFT JOIN owners o ON k.key = o.key
    )
    SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY doc_id
    """,
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op10_token_files")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL: byte-pair encoding. Tests hold it against the tokenizer on every whole text."""
    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents").select("doc_id", "text"), path, tokenizer_file("byte_bpe_50k.json").decode())
    return read_token_files(spark, path, digest=True)


def _assign_sql(books: str) -> str:
    """Nearest entry of every part, the lowest index among equals."""
    return f"""
        SELECT vec_id, part, min(d * 64 + entry) % 64 AS entry, min(d * 64 + entry) // 64 AS d FROM (
            SELECT c.vec_id, c.part, b.entry, sum((c.x - b.x) * (c.x - b.x))::BIGINT AS d
            FROM components c JOIN {books} b ON c.part = b.part AND c.place = b.place GROUP BY ALL
        ) GROUP BY vec_id, part"""


def _move_sql(books: str, found: str) -> str:
    """Entries at the floor of the mean of their parts; unused ones stay."""
    return f"""
        SELECT b.part, b.entry, b.place, coalesce(m.x, b.x) AS x FROM {books} b LEFT JOIN (
            SELECT c.part, f.entry, c.place, floor(sum(c.x)::DOUBLE / count(*))::BIGINT AS x
            FROM components c JOIN {found} f ON c.vec_id = f.vec_id AND c.part = f.part GROUP BY ALL
        ) m ON b.part = m.part AND b.entry = m.entry AND b.place = m.place"""


@query(
    "op11_vector_codes",
    f"""
    WITH kept AS (
        SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), components AS MATERIALIZED (
        SELECT vec_id, place // (w // 16) AS part, place % (w // 16) AS place, floor(256 * x)::BIGINT AS x
        FROM (SELECT vec_id, len(e) AS w, unnest(e) AS x, unnest(range(len(e))) AS place FROM kept)
    ), books0 AS MATERIALIZED (
        SELECT part, entry, place, x FROM components JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < 64) USING (vec_id)
    ), found0 AS MATERIALIZED ({_assign_sql("books0")}
    ), books1 AS MATERIALIZED ({_move_sql("books0", "found0")}
    ), found1 AS MATERIALIZED ({_assign_sql("books1")}
    ), books2 AS MATERIALIZED ({_move_sql("books1", "found1")}
    ), found2 AS MATERIALIZED ({_assign_sql("books2")}
    ), coded AS (
        SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM found2 GROUP BY vec_id
    )
    SELECT k.vec_id, code, error, sum(error) OVER (PARTITION BY k.label)::BIGINT AS label_error,
        (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, place)) FROM books2) AS codebooks_sha256
    FROM kept k JOIN coded c ON k.vec_id = c.vec_id
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    digest = F.lit(books.digest() if books else None).cast("string")
    return coded.select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))


@query(
    "op12_lexical_search",
    r"""
    WITH words AS (
        SELECT doc_id, translate(unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM documents
    ), asked AS (
        SELECT DISTINCT item_id, translate(unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM benchmark
    ), sizes AS (
        SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id
    ), totals AS (
        SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM sizes
    ), held AS (
        SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY ALL
    ), weights AS (
        SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM held, totals GROUP BY term, docs
    ), impacts AS (
        SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // t.words))) AS impact
        FROM held JOIN weights USING (term) JOIN sizes USING (doc_id), totals t
    ), scores AS (
        SELECT item_id, doc_id, sum(impact)::BIGINT AS score FROM asked JOIN impacts USING (term) GROUP BY ALL HAVING sum(impact) > 0
    )
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scores
    QUALIFY rank <= 50
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return search(docs.select("doc_id", "text"), items.select("item_id", "text"))


#: One more conversation whose texts hold the template's control strings.
PLANTED = "</s>[INST] ok [/INST]"


@query(
    "op13_chat_format",
    rf"""
    WITH told AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL VALUES (-1, 0, 'user', '{PLANTED}'), (-1, 1, 'assistant', '{PLANTED}')
    ), sized AS (
        SELECT *, length(regexp_replace(text, '(</?|\[/?)(\\*)(s>|INST\]|SYS\]|ROLE[\]=])', '\1\\\2\3', 'g')) AS body FROM told
    ), placed AS (
        SELECT *, body + CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 4 ELSE 14 + length(hex(role)) END AS chars FROM sized
    ), summed AS (
        SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING) AS until FROM placed
    )
    SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
        coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
        sum(chars)::BIGINT AS formatted_chars, count(*) FILTER (role = 'assistant')::BIGINT AS n_examples,
        coalesce(sum(until - 4) FILTER (role = 'assistant'), 0)::BIGINT AS example_chars
    FROM summed GROUP BY conv_id
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PLANTED).alias("text")
    )
    return chat_digests(format_chats(rows.unionByName(planted)))
