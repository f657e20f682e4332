"""Registered queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_files() -> tuple[str, str, str]:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER), public_tokenizers.path(RANKS), public_tokenizers.PATTERN


def op1_weak_supervision_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from journeyloom.llm.toxicity import score_toxicity

    return score_toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op2_template_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    from journeyloom.llm.decontaminate import leaks

    return leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op3_crf_main_text(spark: SparkSession, folder: str) -> DataFrame:
    from journeyloom.llm.html_text import extract_pages

    return extract_pages(_table(spark, folder, "pages"))


def op4_best_fit_shards(spark: SparkSession, folder: str) -> DataFrame:
    from journeyloom.llm.sharding import shard_digests

    return shard_digests(_table(spark, folder, "documents"), shards=24)


def op5_fm_index_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from journeyloom.llm.substring import without_repeats

    return without_repeats(_table(spark, folder, "documents")).drop("kept")


def op6_compression_licenses(spark: SparkSession, folder: str) -> DataFrame:
    from journeyloom.llm.licenses import scan_licenses

    return scan_licenses(_table(spark, folder, "documents"))


def op7_multi_index_hashing(spark: SparkSession, folder: str) -> DataFrame:
    from journeyloom.llm.neighbours import nearest

    return nearest(_table(spark, folder, "embeddings"))


def op8_ppm_language(spark: SparkSession, folder: str) -> DataFrame:
    from journeyloom.llm.language import identify_languages

    return identify_languages(_table(spark, folder, "documents"))


def op9_hilbert_packing(spark: SparkSession, folder: str) -> DataFrame:
    from journeyloom.llm.packing import piece_digests

    return piece_digests(_table(spark, folder, "documents"), *tokenizer_files(), length=1024)


def op10_t_occurrence_join(spark: SparkSession, folder: str) -> DataFrame:
    from journeyloom.llm.jaccard import jaccard_components

    return jaccard_components(_table(spark, folder, "documents"))


def op11_bayesian_minhash(spark: SparkSession, folder: str) -> DataFrame:
    from journeyloom.llm.minhash import kept_documents

    return kept_documents(_table(spark, folder, "documents"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    from journeyloom.llm.prefixes import prefix_trie

    return prefix_trie(_table(spark, folder, "conversations"), family=20, most=4)


def op13_sparse_diagonal_runs(spark: SparkSession, folder: str) -> DataFrame:
    from journeyloom.llm.runs import periodic_runs, run_digests

    return run_digests(periodic_runs(_table(spark, folder, "documents"), planted=True))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES = {
    "pipeline": pipeline,
    "op1_weak_supervision_toxicity": op1_weak_supervision_toxicity,
    "op2_template_decontamination": op2_template_decontamination,
    "op3_crf_main_text": op3_crf_main_text,
    "op4_best_fit_shards": op4_best_fit_shards,
    "op5_fm_index_dedup": op5_fm_index_dedup,
    "op6_compression_licenses": op6_compression_licenses,
    "op7_multi_index_hashing": op7_multi_index_hashing,
    "op8_ppm_language": op8_ppm_language,
    "op9_hilbert_packing": op9_hilbert_packing,
    "op10_t_occurrence_join": op10_t_occurrence_join,
    "op11_bayesian_minhash": op11_bayesian_minhash,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_sparse_diagonal_runs": op13_sparse_diagonal_runs,
}

_WORDS = r"'[^\x20\x09-\x0D]+'"



def _crc32(number: str) -> str:
    """SQL: unsigned crc32 of a number's decimal digits."""
    rounds = ", ".join(["-1"] * 8)
    steps = f"flatten(list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda c: [ascii(c), {rounds}]))"
    shift = "xor(acc >> 1, 3988292384 * (acc & 1))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {steps}), lambda acc, x: CASE WHEN x < 0 THEN {shift} ELSE xor(acc, x) END), 4294967295)"


def _near_duplicates(words: int, percent: int, more: str = "") -> str:
    """SQL: components of documents whose sets of ``words``-word shingles reach the similarity."""
    return f"""
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WORDS}) AS ws
          FROM documents
        ),
        s AS (
          SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i + {words} - 1], ' ')) AS h
          FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {words} + 2, least(len(ws) + 1, 2)))) AS i FROM w)
        ),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (h) GROUP BY ALL),
        links AS (
          SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {percent} * (x.n + y.n - c)
        ),
        reach AS (
          SELECT doc_id, doc_id AS other FROM w UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
        )
        SELECT doc_id, CAST(coalesce(max(n.n), 0) AS BIGINT) AS n_shingles, min(other) AS component_id{more}
        FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id"""


ORACLE: dict[str, str] = {
    "op5_fm_index_dedup": f"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS ws FROM documents),
        win AS (
          SELECT doc_id, i, md5(array_to_string(ws[i:i + 12], ' ')) AS h
          FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)
        ),
        least AS (SELECT h, min(doc_id) AS first FROM win GROUP BY h),
        gone AS (
          SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS pos FROM win JOIN least USING (h) WHERE first < doc_id
        ),
        every AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM w),
        kept AS (
          SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS t, count(*) AS n
          FROM every ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(t, '')) AS kept_sha256
        FROM w LEFT JOIN kept USING (doc_id)""",
    "op10_t_occurrence_join": _near_duplicates(5, 75),
    "op11_bayesian_minhash": _near_duplicates(2, 80, ", doc_id = min(other) AS kept"),
    "op12_prefix_trie": f"""
        WITH turn_ AS (
          SELECT conv_id, md5(concat(md5(coalesce(role, '')), md5(coalesce(text, '')))) AS d,
                 len(regexp_extract_all(coalesce(text, ''), {_WORDS})) AS words,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                                    md5(concat(md5(coalesce(role, '')), md5(coalesce(text, ''))))) AS pos
          FROM conversations WHERE conv_id IS NOT NULL
        ),
        conv AS (SELECT conv_id, list(struct_pack(d := d, words := words) ORDER BY pos) AS own FROM turn_ GROUP BY conv_id),
        rebuilt AS (
          SELECT c.conv_id, list_concat(coalesce(b.own, [])[1:{_crc32("c.conv_id")} % 4], c.own[{_crc32("c.conv_id")} % 4 + 1:]) AS turns
          FROM conv c LEFT JOIN conv b ON b.conv_id = c.conv_id - c.conv_id % 20
        ),
        chain AS (
          SELECT conv_id, len(turns) AS size, depth, md5(array_to_string(list_transform(turns[1:depth], lambda t: t.d), '')) AS key,
                 CASE WHEN depth > 0 THEN md5(array_to_string(list_transform(turns[1:depth - 1], lambda t: t.d), '')) END AS up,
                 coalesce(turns[depth].words, 0) AS words
          FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS depth FROM rebuilt)
        ),
        node AS (
          SELECT depth, key, min(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
                 sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256
          FROM chain GROUP BY depth, key
        ),
        child AS (SELECT depth - 1 AS depth, up AS key, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL),
        full_ AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN child USING (depth, key)),
        below AS (
          SELECT a.depth, a.key, sum(CAST(v.n_children = 0 AS BIGINT)) AS n_leaves, sum((v.n_convs - 1) * v.words) AS saved_tokens
          FROM full_ v JOIN chain a ON a.conv_id = v.conv_id AND a.depth <= v.depth GROUP BY a.depth, a.key
        )
        SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
               CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
        FROM full_ n JOIN below USING (depth, key) LEFT JOIN node p ON p.depth = n.depth - 1 AND p.key = n.up""",
    "op13_sparse_diagonal_runs": f"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS ws, {_crc32("doc_id")} AS h FROM documents),
        plan AS (
          SELECT *, len(ws) AS n, h % 10 = 0 AND len(ws) > 0 AS planted, (h // 10) % greatest(len(ws), 1) AS a, (h // 10) % 8 AS e FROM w
        ),
        place AS (SELECT *, 1 + (n - a) // (3 + e) AS p, unnest(range(n)) AS i FROM plan),
        word AS (SELECT doc_id, i, ws[CASE WHEN planted AND i >= a THEN a + (i - a) % p ELSE i END + 1] AS word FROM place),
        step AS (
          SELECT doc_id, x.i, x.i - y.i AS lag FROM word x JOIN word y USING (doc_id, word) WHERE x.i > y.i
        ),
        stretch AS (
          SELECT doc_id, lag, min(i) - lag AS start, max(i) + 1 AS stop
          FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, lag ORDER BY i) AS part FROM step)
          GROUP BY doc_id, lag, part
        ),
        run AS (
          SELECT doc_id, start, stop - start AS length, min(lag) AS period
          FROM stretch WHERE stop - start >= greatest(12, 2 * lag) GROUP BY doc_id, start, stop
        ),
        best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) AS r FROM run),
        lines AS (
          SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS t
          FROM run GROUP BY doc_id
        ),
        gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM run),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
        SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
               sha256(coalesce(lines.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
        FROM w LEFT JOIN lines USING (doc_id) LEFT JOIN (SELECT * FROM best WHERE r = 1) USING (doc_id) LEFT JOIN kept USING (doc_id)""",
}
