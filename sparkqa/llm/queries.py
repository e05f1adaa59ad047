"""The registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkqa.llm import alignment, imi, kneser_ney, langid, licenses, line_dedup, merkle, mixing, ngram_join, packing, pii, rabitq, sharding
from sparkqa.llm.common import table
from sparkqa.session import scratch_path


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.removed(table(spark, sf_dir, "documents"), edits=2, min_chars=20) \
        .select("doc_id", "n_lines", "n_removed", "removed")


def op2_rabitq_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rabitq.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op3_pii_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"))


def op4_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = sharding.shard(table(spark, sf_dir, "documents"), shards=40, map_path=scratch_path(spark, "slot-maps"))
    return d.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A public tokenizer's file; every machine has the installed package."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op5_configuration_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), threshold=0.8)


def op7_multi_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imi.duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op8_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = mixing.mix(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "size", "source_size", "target", "taken",
                    F.get("positions", F.lit(0)).alias("position")).orderBy("position", "doc_id")


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"), words=3, percent=90) \
        .select("doc_id", "n_shingles", "component_id")


def op10_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")) \
        .select("doc_id", "lang", "n_words", "perplexity", "shrunk_perplexity", "threshold", "kept")


def op11_word_backoff_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proven(table(spark, sf_dir, "documents")) \
        .select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_spill_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_rabitq_search, op3_pii_boosted, op4_virtual_slots, op5_configuration_pack, op6_license_scan, op7_multi_index_dedup,
    op8_curriculum_mix, op9_ngram_jaccard, op10_kneser_ney_quality, op11_word_backoff_language, op12_merkle_manifest, op13_spill_alignment)}
# --- DuckDB SQL of what SQL can express ---------------------------------------------------------------
# (Sharding needs CRC-32, packing the tokenizer; personal data, line dedup and quality have no SQL
# form of a bearable cost.  The tests hold those against brute-force versions.)
_USABLE = ("embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 "
           "AND len(list_filter(embedding, lambda x: x <> 0)) > 0")
_REACH = ("reach(a, b) AS (SELECT id, id FROM nodes UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b), "
          "comp AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a) ")
_WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"

_FIELD = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"
_LEAF = lambda n: "sha256(" + " || ".join(_FIELD(c) for c in ("doc_id", "source", "lang", n, "text")) + ")"
_CRC = ("xor(4294967295, list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: ascii(ch)::BIGINT), "
        "lambda acc, b: list_reduce([xor(acc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))))")
# levels of a forest (g, lvl, pos, n, h), two nodes to one until a group has a single node
_CLIMB = ("SELECT g, lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM {0} WHERE n > 1 GROUP BY g, lvl, pos // 2, n")

ORACLE: dict[str, str] = {
    "op12_merkle_manifest": f"""
        WITH RECURSIVE leaves AS (SELECT doc_id, lang, {_LEAF('n_chars')} AS leaf,
            CASE WHEN n_chars IS NOT NULL AND {_CRC} % 7 = 0 THEN {_LEAF('(n_chars + 1)')} END AS other FROM documents),
        placed AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
            row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM leaves),
        low(g, lvl, pos, n, h) AS (SELECT g, 0, pos, n, leaf FROM placed UNION ALL {_CLIMB.format('low')}),
        sub AS (SELECT g, h FROM low WHERE n = 1),
        top(g, lvl, pos, n, h) AS (SELECT 0, 0, g, (SELECT count(*) FROM sub), h FROM sub UNION ALL {_CLIMB.format('top')}),
        steps AS (
            SELECT p.g, p.pos, 0 AS tree, l.lvl, CASE WHEN s.pos < l.pos THEN s.h ELSE '' END AS a, CASE WHEN s.pos > l.pos THEN s.h ELSE '' END AS b
            FROM placed p JOIN low l ON l.g = p.g AND l.pos = p.pos >> l.lvl AND l.n > 1 LEFT JOIN low s ON s.g = l.g AND s.lvl = l.lvl AND s.pos = xor(l.pos, 1)
            UNION ALL
            SELECT p.g, p.pos, 1, l.lvl, CASE WHEN s.pos < l.pos THEN s.h ELSE '' END, CASE WHEN s.pos > l.pos THEN s.h ELSE '' END
            FROM placed p JOIN top l ON l.pos = p.g >> l.lvl AND l.n > 1 LEFT JOIN top s ON s.lvl = l.lvl AND s.pos = xor(l.pos, 1)),
        paths AS (SELECT g, pos, list({{'a': a, 'b': b}} ORDER BY tree, lvl) AS path FROM steps GROUP BY g, pos),
        folded AS (SELECT p.doc_id, p.leaf, sub.h AS subroot, (SELECT h FROM top WHERE n = 1) AS root,
            sha256(coalesce(array_to_string(list_transform(path, lambda x: x.a || x.b), ''), '')) AS proof_sha256,
            list_reduce([coalesce(other, leaf)] || coalesce(list_transform(path, lambda x: x.a || '|' || x.b), []),
                        lambda x, s: sha256(split_part(s, '|', 1) || x || split_part(s, '|', 2))) AS folded_root
            FROM placed p JOIN sub USING (g) LEFT JOIN paths USING (g, pos))
        SELECT *, folded_root = root AS verified FROM folded""",
    "op2_rabitq_search": f"""
        WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE {_USABLE}),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
              FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM
        (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20""",
    "op7_multi_index_dedup": f"""
        WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND {_USABLE}),
        links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id
                  AND list_cosine_similarity(x.e, y.e) >= 0.93),
        nodes AS (SELECT vec_id AS id FROM embeddings), {_REACH}
        SELECT id AS vec_id, (SELECT count(*) FROM links l WHERE l.a = id) AS n_links, component_id, component_id = id AS kept FROM comp""",
    "op8_curriculum_mix": f"""
        WITH d AS (SELECT doc_id, source, CAST(coalesce(len({_WORDS}), 0) AS BIGINT) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
        b AS (SELECT *, CAST(('0x' || substr(h, 1, 8)) AS BIGINT) % 512 AS part FROM d),
        s AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank FROM (SELECT source, sum(size) AS source_size FROM d GROUP BY source)),
        w AS (SELECT *, [3.0, 1.0, 2.0][rank % 3 + 1]::DOUBLE AS weight, (source_size * 2)::DOUBLE AS cap FROM s),
        o AS (SELECT *, (sum(source_size) OVER ()) * 1.5::DOUBLE AS total,
              coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone,
              sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM w),
        l AS (SELECT *, (total - gone) / rest AS level FROM o),
        f AS (SELECT *, first(CASE WHEN level * weight < cap THEN level END IGNORE NULLS) OVER (ORDER BY cap / weight, rank
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS final FROM l),
        t AS (SELECT source, CAST(source_size AS BIGINT) AS source_size, rank, coalesce(least(final * weight, cap), cap) AS target FROM f),
        r AS (SELECT b.doc_id, b.size, t.source_size, t.target, t.rank, CAST(coalesce(sum(b.size) OVER (PARTITION BY b.source ORDER BY part, h, b.doc_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM b JOIN t ON b.source IS NOT DISTINCT FROM t.source),
        k AS (SELECT *, greatest(0, least(CAST(round(target) AS BIGINT) - start, size)) AS one,
              greatest(0, least(CAST(round(target) AS BIGINT) - start - source_size, size)) AS two FROM r),
        p AS (SELECT *, CASE WHEN one > 0 THEN (start + one / 2) / target END AS x FROM k)
        SELECT doc_id, size, source_size, target, CAST(one + two AS BIGINT) AS taken,
        CASE WHEN x IS NOT NULL THEN least(1.0, CASE rank % 3 WHEN 0 THEN 2 * x / (1.6 + sqrt(greatest(1.6 * 1.6 - 2.4 * x, 0))) WHEN 1 THEN x
              ELSE CASE WHEN x >= 0.35 THEN 0.5 + 2 * (x - 0.35) / (1.0 + sqrt(1.0 + 2.4 * (x - 0.35))) ELSE least(0.5, 2 * x / (0.4 + sqrt(0.16 + 2.4 * x))) END END) END AS position
        FROM p""",
    "op9_ngram_jaccard": f"""
        WITH RECURSIVE t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
        w AS (SELECT doc_id, {_WORDS} AS w FROM t),
        g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
              WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
        links AS (SELECT i.a, i.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM g x JOIN g y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2) i
                  JOIN n na ON na.doc_id = i.a JOIN n nb ON nb.doc_id = i.b WHERE 100 * c >= 90 * (na.n + nb.n - c)),
        nodes AS (SELECT doc_id AS id FROM documents), {_REACH}
        SELECT id AS doc_id, coalesce(n.n, 0) AS n_shingles, component_id FROM comp LEFT JOIN n ON n.doc_id = id""",
}
