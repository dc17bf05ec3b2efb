"""The queries of this subpackage, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.llm.collocations import collocations
from reviewmill.llm.conversations import lend_heads, number_turns, prefix_trie
from reviewmill.llm.exact_copies import exact_groups
from reviewmill.llm.mixing import mix_sources
from reviewmill.llm.near_copies import near_groups
from reviewmill.llm.near_vectors import near_vectors
from reviewmill.llm.packing import pack
from reviewmill.llm.pii import find_personal_data
from reviewmill.llm.quality import judge_quality
from reviewmill.llm.repeats import remove_repeats
from reviewmill.llm.sharding import LAW, shard_documents
from reviewmill.llm.shipping import ship_package
from reviewmill.llm.token_files import read_documents, write_token_files
from reviewmill.llm.url_rules import judge_urls
from reviewmill.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

# Targets of the mix: part of the largest possible entropy, and passes over a source.
ENTROPY_SHARE, MAX_REPEATS = 0.95, 2.0

SHARDS, SHARD_SEED = 16, 7

# The rules that the URL query judges by: host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def vocabulary(name: str) -> str:
    """A file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _shipped(query: Query) -> Query:
    """The query with this package at hand in the executors' Python."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    judged = judge_quality(docs, labels)
    return judged.select("doc_id", "text_odds", "host_mean", "path_mean", "quality", "kept")


def op2_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(_table(spark, sf_dir, "documents"), percent=85)


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return mix_sources(docs, entropy_share=ENTROPY_SHARE, max_repeats=MAX_REPEATS)


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(_table(spark, sf_dir, "documents")).drop("redacted")


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, rules).drop("url")


def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.95)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    docs = _table(spark, sf_dir, "documents")
    write_token_files(docs, path, vocabulary("word_bpe_49k.json"), space_led=False, end_id=1)
    return read_documents(spark, path)


def op8_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pack(docs, vocabulary("byte_bpe_50k.json"), space_led=True, end_id=2, size=1024)


def op9_exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_table(spark, sf_dir, "documents"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents"))


def op11_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(_table(spark, sf_dir, "documents"), shards=SHARDS, seed=SHARD_SEED)
    return placed.select(
        "doc.doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, conversations = number_turns(_table(spark, sf_dir, "conversations"))
    return prefix_trie(*lend_heads(turns, conversations)).drop("high", "low")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    named = {
        "op1_site_quality": op1_site_quality,
        "op2_near_copies": op2_near_copies,
        "op3_source_mix": op3_source_mix,
        "op4_personal_data": op4_personal_data,
        "op5_url_rules": op5_url_rules,
        "op6_near_vectors": op6_near_vectors,
        "op7_token_files": op7_token_files,
        "op8_best_two_fit": op8_best_two_fit,
        "op9_exact_copies": op9_exact_copies,
        "op10_repeats": op10_repeats,
        "op11_stratified_shards": op11_stratified_shards,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_collocations": op13_collocations,
    }
    return {name: _shipped(query) for name, query in named.items()}


def _components(key: str, table: str) -> str:
    """Steps from links (a, b) to the smallest id that each row of a table reaches."""
    return f"""
            both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
            reach(id, other) AS (
                SELECT {key}, {key} FROM {table}
                UNION SELECT r.id, l.b FROM reach r JOIN both_ways l ON r.other = l.a),
            components AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)"""


# Unsigned crc32 of a text's UTF-8 bytes; the table of its 256 steps comes from the polynomial.
_CRC_TABLE = """
            crc_table AS (
                SELECT list(list_reduce(list_prepend(i, range(8)),
                    lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS steps
                FROM (SELECT unnest(range(256)) AS i))"""


def _crc32(text: str) -> str:
    """SQL for rows that are joined with crc_table."""
    codes = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS BIGINT))"
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295, {codes}),
                lambda c, b: xor(c >> 8, steps[xor(c, b) % 256 + 1])))"""


def oracle_sql() -> dict[str, str]:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    return {
        "op2_near_copies": r"""
            WITH RECURSIVE words AS (
                SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
                FROM documents),
            places AS (
                SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0),
            shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM places),
            sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
            common AS (
                SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
                FROM shingles x JOIN shingles y USING (s) WHERE x.doc_id < y.doc_id GROUP BY ALL),
            links AS (
                SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
                WHERE 100 * c >= 85 * (x.n + y.n - c)),"""
        + _components("doc_id", "documents")
        + """
            SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
            FROM documents JOIN components ON id = doc_id LEFT JOIN sizes USING (doc_id)""",
        "op5_url_rules": rf"""
            WITH rules(h, p, v) AS (VALUES {rules}),
            parts AS (
                SELECT page_id,
                    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
                FROM pages),
            best AS (
                SELECT *, (SELECT arg_max(struct_pack(rule := h || p, verdict := v), length(h || p))
                    FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS won
                FROM parts)
            SELECT page_id, host, path, won.rule AS rule, coalesce(won.verdict, 'allow') AS verdict
            FROM best""",
        "op6_near_vectors": """
            WITH RECURSIVE sound AS (
                SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v,
                    CASE WHEN list_count(embedding) = len(embedding)
                        THEN list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) END AS size
                FROM embeddings),
            usable AS (SELECT vec_id, v FROM sound WHERE size > 0 AND isfinite(size)),
            links AS (
                SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.vec_id < y.vec_id
                WHERE len(x.v) = len(y.v) AND list_cosine_similarity(x.v, y.v) >= 0.95),"""
        + _components("vec_id", "embeddings")
        + """
            SELECT vec_id, (SELECT count(*) FROM both_ways WHERE a = vec_id) AS n_links, component_id,
                vec_id = component_id AS kept
            FROM embeddings JOIN components ON id = vec_id""",
        "op9_exact_copies": r"""
            WITH base AS (
                SELECT doc_id, length(coalesce(text, '')) AS size,
                    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS content
                FROM documents),
            groups AS (
                SELECT content, count(*) AS group_size,
                    arg_min(doc_id, struct_pack(a := -size, b := doc_id)) AS keep_id
                FROM base GROUP BY content)
            SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256
            FROM base JOIN groups USING (content)""",
        "op11_stratified_shards": f"""
            WITH {_CRC_TABLE.strip()},
            keyed AS (
                SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS name, source IS NULL AS unnamed,
                    md5('{SHARD_SEED}:' || doc_id || ':' || md5(coalesce(text, ''))) AS spot
                FROM documents),
            ranked AS (
                SELECT *, (2 * row_number() OVER (PARTITION BY name, unnamed ORDER BY spot) - 1)::DOUBLE
                    / (2 * count(*) OVER (PARTITION BY name, unnamed))::DOUBLE AS fraction
                FROM keyed),
            placed AS (
                SELECT *, row_number() OVER (ORDER BY fraction, unnamed, name, spot) AS place, count(*) OVER () AS total
                FROM ranked),
            cut AS (SELECT *, ({SHARDS} * place - 1) // total AS shard FROM placed)
            SELECT doc_id, strlen(text) + 1 AS size, {_crc32("text")} AS text_crc32, '{LAW}' AS law,
                CAST(shard AS INTEGER) AS shard, place - 1 - shard * total // {SHARDS} AS slot,
                CAST(NULL AS INTEGER) AS grown_shard
            FROM cut, crc_table""",
        "op12_prefix_trie": f"""
            WITH {_CRC_TABLE.strip()},
            numbered AS (
                SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                    row_number() OVER (PARTITION BY conv_id
                        ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
                FROM conversations WHERE conv_id IS NOT NULL),
            convs AS (
                SELECT c, {_crc32("CAST(c AS VARCHAR)")} % 6 AS h FROM (SELECT DISTINCT c FROM numbered), crc_table),
            rebuilt AS (
                SELECT v.c, row_number() OVER (PARTITION BY v.c ORDER BY origin, place) AS d, role, text
                FROM convs v JOIN (
                    SELECT v.c, 0 AS origin, place, role, text
                    FROM convs v JOIN numbered n ON n.c = v.c - v.c % 100 AND place <= h
                    UNION ALL
                    SELECT v.c, 1, place, role, text FROM convs v JOIN numbered n ON n.c = v.c AND place > h) t USING (c)),
            paths AS (
                SELECT c, d, length(text) AS size, string_agg(sha256(length(role) || ':' || role || text), '')
                    OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING) AS path
                FROM rebuilt
                UNION ALL SELECT c, 0, 0, '' FROM convs),
            keyed AS (SELECT c, d, size, sha256(path) AS id, lag(sha256(path)) OVER (PARTITION BY c ORDER BY d) AS up,
                d = max(d) OVER (PARTITION BY c) AS last FROM paths),
            nodes AS (
                SELECT d, id, any_value(up) AS up, any_value(size) AS size, min(c) AS c, count(*) AS n,
                    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (last), '')) AS ends
                FROM keyed GROUP BY d, id),
            children AS (SELECT d - 1 AS d, up AS id, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
            grown AS (SELECT *, coalesce(n_children, 0) AS kids FROM nodes LEFT JOIN children USING (d, id)),
            sums AS (
                SELECT k.d, k.id, count(*) FILTER (g.kids = 0) AS n_leaves, sum((g.n - 1) * g.size) AS saved
                FROM grown g JOIN keyed k ON k.c = g.c AND k.d <= g.d GROUP BY ALL)
            SELECT g.c AS conv_id, d AS depth, p.c AS parent_conv_id, g.n AS n_convs, kids AS n_children,
                n_leaves, CAST(saved AS BIGINT) AS saved_tokens, g.ends AS ends_sha256
            FROM grown g JOIN sums s USING (d, id)
            LEFT JOIN (SELECT d + 1 AS d, id AS up, c FROM nodes) p USING (d, up)""",
        "op13_collocations": r"""
            WITH pieces AS (
                SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
                FROM documents),
            words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
            totals AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
            sizes AS (SELECT unnest(range(1, 5)) AS size),
            found AS (
                SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
                FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM words, sizes)),
            f AS (SELECT lang, size, phrase, count(*) AS f FROM found GROUP BY ALL HAVING count(*) >= 30),
            cuts AS (
                SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k
                FROM f WHERE size > 1),
            scored AS (
                SELECT c.lang, c.size, c.phrase, a, k, x.f AS l, y.f AS r,
                    CAST(a AS HUGEINT) * 2000000 // (x.f + y.f) AS score
                FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[:k], ' ')
                JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ')),
            lowest AS (
                SELECT * FROM scored
                QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
            inner_parts AS (
                SELECT lang, f, w, size, i FROM (
                    SELECT lang, f, w, size, unnest(range(1, length - size + 2)) AS i FROM (
                        SELECT lang, f, size AS length, string_split(phrase, ' ') AS w, unnest(range(2, size)) AS size
                        FROM f WHERE size > 2))),
            around AS (
                SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(f) AS most
                FROM inner_parts GROUP BY ALL),
            stay AS (
                SELECT lowest.* FROM lowest LEFT JOIN around USING (lang, phrase)
                WHERE most IS NULL OR CAST(most AS HUGEINT) * 100 < CAST(a AS HUGEINT) * 80)
            SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
                phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
            FROM stay JOIN totals USING (lang) QUALIFY rank <= 2000""",
    }
