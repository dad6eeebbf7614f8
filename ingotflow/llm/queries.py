"""The contract queries of this folder: thin wrappers that give each operator its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ingotflow.llm import (
    byte_bpe,
    collocations,
    decontaminate,
    language_id,
    license_scan,
    main_text,
    manifest,
    near_dedup,
    piece_bpe,
    secret_scan,
    token_counts,
    topk,
    toxicity,
)
from ingotflow.llm.common import remainder, table

#: Documents with more tokens than this are over the limit.
TOKEN_LIMIT = 4096
#: Columns of a document that its leaf of the manifest hashes.
LEAF = ("doc_id", "source", "lang", "n_chars", "text")
#: Phrases reported of each language.
PHRASES = 2000


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best partners of every fiftieth vector."""
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document."""
    return license_scan.notices(table(spark, sf_dir, "documents"))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return main_text.extract_pages(table(spark, sf_dir, "pages"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents, on two-word shingles."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=2)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    documents = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))  # a null id is not held out
    model = language_id.fit(documents.where(~held_out))
    return (language_id.identify(documents, model, keep=(held_out.alias("held_out"),))
            .select("doc_id", "held_out", "lang_pred", "score"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels that are not held out."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))  # a null id is not held out
    grammar = toxicity.fit(documents, labels.where(~held_out))
    return (toxicity.score(documents, grammar, keep=(held_out.alias("held_out"),))
            .select("doc_id", "held_out", "score", "predicted"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the piece model."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("piece_bpe_32k.model"), TOKEN_LIMIT)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by the byte-level ranks, and decoded again."""
    return byte_bpe.digests(table(spark, sf_dir, "documents"),
                            public_tokenizers.path("byte_bpe_50k.tiktoken"),
                            public_tokenizers.PATTERN)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, scanned with an empty ledger."""
    found, _ = secret_scan.scan(table(spark, sf_dir, "documents"))
    base = [rule.kind for rule in secret_scan.BASE]

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(
            ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    of_base = F.filter("findings", lambda x: x["kind"].isin(base))
    return found.select("doc_id", *map(count, base), F.sha2(joined(of_base), 256).alias("base_sha256"),
                        joined(F.col("findings")).alias("spans"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in every document."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"),
                                       table(spark, sf_dir, "benchmark"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents; where 3 divides the id's hash, of a text turned to lower case."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    changed = [F.translate(c, upper, lower) if c == "text" else F.col(c) for c in LEAF]
    tampered = F.when(remainder("doc_id", 3) == 0, manifest.leaf(changed))
    rows = manifest.build(table(spark, sf_dir, "documents"), LEAF, extra={"tampered": tampered})
    folded = manifest.folded(F.col("path"), F.coalesce("tampered", "leaf"))
    return (rows.withColumn("folded_root", folded)
            .select("doc_id", "leaf", "subroot", "root", F.sha2(manifest.siblings(F.col("path")), 256).alias("proof_sha256"),
                    "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")))


def op12_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by the piece model, and decoded again."""
    return piece_bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of each language."""
    return collocations.top(table(spark, sf_dir, "documents"), PHRASES).drop("cut")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_topk": op1_exact_topk,
    "op2_license_scan": op2_license_scan,
    "op3_main_text": op3_main_text,
    "op4_near_dedup": op4_near_dedup,
    "op5_language_id": op5_language_id,
    "op6_toxicity": op6_toxicity,
    "op7_token_counts": op7_token_counts,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_secret_scan": op9_secret_scan,
    "op10_decontamination": op10_decontamination,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_piece_bpe": op12_piece_bpe,
    "op13_collocations": op13_collocations,
}

#: Two-word shingle sets, links and components of ``documents``.
NEAR_DUPLICATES = r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(string_split_regex(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
                       lambda x: x <> '') AS w
            FROM documents),
        shingles AS (
            SELECT doc_id, unnest(CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(
                       range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END) AS s
            FROM words),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (
            SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * s.n >= 80 * (x.n + y.n - s.n)),
        reached AS (
            SELECT doc_id, doc_id AS other FROM documents
            UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a),
        components AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)"""


def merkle_sql(group_levels: int = 7, top_levels: int = 4) -> str:
    """The manifest, its levels written out: enough for ``8 ** levels`` leaves of a group, and groups."""
    def field(c: str) -> str:
        return f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return f"sha256(concat({', '.join(field(text if c == 'text' else c) for c in LEAF)}))"

    parts = [f"""
        crc_table AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, _:
                          CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS entries
                      FROM (SELECT unnest(range(256)) AS i)),
        numbered AS (
            SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
                           string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                       lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1])), 4294967295) AS crc
            FROM documents, crc_table),
        leaves AS (
            SELECT doc_id, lang, {leaf("text")} AS leaf, CASE WHEN crc % 3 = 0 THEN {leaf(
                "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered
            FROM numbered),
        a0 AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, leaf AS h,
                      count(*) OVER (PARTITION BY lang) AS n, doc_id, leaf, tampered FROM leaves)"""]

    def climb(name: str, levels: int) -> None:
        for k in range(levels):
            parts.append(f"""
        {name}{k + 1} AS (
            SELECT lang, pos // 8 AS pos, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY pos))
                                              ELSE any_value(h) END AS h, (any_value(n) + 7) // 8 AS n
            FROM {name}{k} GROUP BY lang, pos // 8),
        {name}_runs{k} AS (SELECT lang, pos // 8 AS run, list(h ORDER BY pos) AS hs FROM {name}{k} WHERE n > 1 GROUP BY ALL)""")

    def fold(out: str, name: str, levels: int) -> None:
        for k in range(levels):
            left, right = "array_to_string(hs[1:f.pos % 8], '')", "array_to_string(hs[f.pos % 8 + 2:], '')"
            parts.append(f"""
        {out}{k + 1} AS (
            SELECT f.* EXCLUDE (pos, h, proof), f.pos // 8 AS pos,
                   CASE WHEN hs IS NULL THEN f.h ELSE sha256({left} || f.h || {right}) END AS h,
                   CASE WHEN hs IS NULL THEN proof ELSE proof || {left} || {right} END AS proof
            FROM {out}{k} f LEFT JOIN {name}_runs{k} r ON f.g IS NOT DISTINCT FROM r.lang AND f.pos // 8 = r.run)""")

    climb("a", group_levels)
    parts.append(f"""
        b0 AS (SELECT 0 AS lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, h, count(*) OVER () AS n,
                      lang AS member FROM a{group_levels})""")
    climb("b", top_levels)
    parts.append("""
        f0 AS (SELECT doc_id, lang AS g, lang AS member, leaf, pos, coalesce(tampered, leaf) AS h, '' AS proof FROM a0)""")
    fold("f", "a", group_levels)
    parts.append(f"""
        e0 AS (SELECT f.doc_id, 0 AS g, f.leaf, b.h AS subroot, b.pos, f.h, f.proof
               FROM f{group_levels} f JOIN b0 b ON f.member IS NOT DISTINCT FROM b.member)""")
    fold("e", "b", top_levels)
    return f"""
        WITH {",".join(parts)}
        SELECT doc_id, leaf, subroot, t.h AS root, sha256(proof) AS proof_sha256, e.h AS folded_root, e.h = t.h AS verified
        FROM e{top_levels} e, b{top_levels} t"""


#: Words, phrases and the best collocations of ``documents``.
COLLOCATIONS = r"""
        WITH pieces AS (
            SELECT row_number() OVER () AS piece, lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
            FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
        spans AS (SELECT lang, w, unnest([1, 2, 3, 4]) AS size FROM pieces),
        phrases AS (SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2),
                               lambda i: w[i:i + size - 1])) AS p FROM spans),
        counted AS (SELECT lang, size, p, count(*) AS f FROM phrases GROUP BY ALL),
        totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE size = 1 GROUP BY lang),
        candidates AS (SELECT * FROM counted WHERE size > 1 AND f >= 30),
        covered AS (
            SELECT lang, p[i:i + m - 1] AS p, max(f) AS longer
            FROM (SELECT lang, p, f, size, m, unnest(range(1, size - m + 2)) AS i
                  FROM (SELECT *, unnest([2, 3]) AS m FROM candidates) WHERE m < size) GROUP BY ALL),
        kept AS (SELECT c.* FROM candidates c LEFT JOIN covered v ON c.lang = v.lang AND c.p = v.p
                 WHERE longer IS NULL OR 100 * longer < 80 * f),
        cuts AS (SELECT *, p[1:k] AS lp, p[k + 1:] AS rp FROM (SELECT *, unnest(range(1, size)) AS k FROM kept)),
        scored AS (
            SELECT c.lang, c.p, c.f AS a, x.f AS l, y.f AS r, k,
                   CAST((2000000 * c.f::HUGEINT) // (x.f::HUGEINT + y.f) AS BIGINT) AS score
            FROM cuts c JOIN counted x ON x.lang = c.lang AND x.p = lp JOIN counted y ON y.lang = c.lang AND y.p = rp),
        lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
        best AS (SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score FROM lowest),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""


def containment_sql(short: str, key: str) -> str:
    """Tables of the five-word shingles of ``documents`` and of a table of short texts, and ``found``:
    the short texts of which a document holds 80 in 100."""
    def shingles(rows: str, id_column: str) -> str:
        return f"""
            SELECT DISTINCT id, unnest(list_transform(range(1, len(w) - 3), lambda i:
                       array_to_string(w[i:i + 4], ' '))) AS s
            FROM (SELECT {id_column} AS id, list_filter(string_split_regex(
                             lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w
                  FROM {rows} WHERE {id_column} IS NOT NULL AND text IS NOT NULL) WHERE len(w) >= 5"""

    return f"""
        long_shingles AS ({shingles("documents", "doc_id")}),
        short_shingles AS ({shingles(short, key)}),
        short_sizes AS (SELECT id, count(*) AS n FROM short_shingles GROUP BY id),
        found AS (
            SELECT l.id AS doc_id, s.id AS {key}, count(*) AS shared, n AS n_shingles
            FROM long_shingles l JOIN short_shingles s USING (s) JOIN short_sizes z ON z.id = s.id
            GROUP BY ALL HAVING 100 * count(*) >= 80 * n)"""


#: SQL that DuckDB runs over the same tables, where SQL can express the operator.
ORACLES: dict[str, str] = {
    "op11_merkle_manifest": merkle_sql(),
    "op13_collocations": COLLOCATIONS,
    "op1_exact_topk": """
        WITH vectors AS (
            SELECT vec_id, list_transform(embedding, lambda x:
                       CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scores AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(range(1, least(len(q.w), len(c.w)) + 1),
                                                lambda i: q.w[i] * c.w[i])) AS BIGINT) AS score
            FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
        ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)
                           AS INTEGER) AS rank
            FROM scores)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op10_decontamination": f"""
        WITH {containment_sql("benchmark", "item_id")} SELECT * FROM found""",
    "op4_near_dedup": NEAR_DUPLICATES + """
        SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id,
               d.doc_id = c.component_id AS kept
        FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN components c USING (doc_id)""",
}
