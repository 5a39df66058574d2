"""The registered queries of this subpackage: each operator over its whole table, and oracle SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import work_path
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op1_rans_tokens")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import rans
    from .tokens import vocabulary_path

    folder = work_path(spark, "op1-files")
    rans.write(table(spark, sf_dir, "documents"), folder, vocabulary_path("word_bpe_49k.json"), end_id=1)
    return rans.digests(spark, folder)


@register("op10_best_fit_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import packing
    from .tokens import vocabulary_path

    items = packing.pieces(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"), 2, 1024)
    return packing.pack(items, 1024)


@register("op5_exact_dedup", """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size, sha256(norm) AS text_sha256 FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, g.text_sha256 FROM t JOIN g USING (norm)""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import exact

    return exact.dedup(table(spark, sf_dir, "documents"), keep="last").drop("rid")


OP4_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                  md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS ord FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, ([3.0, 1.0, 2.0]::DOUBLE[])[CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)] AS weight,
             source_size * 2.0::DOUBLE AS cap FROM s),
l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER p, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER p, 0)) AS level
      FROM w WINDOW p AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, (SELECT arg_min(level, cap / weight) FROM l WHERE cap > weight * level) AS water FROM l),
t AS (SELECT source, source_size, CASE WHEN water IS NULL THEN cap ELSE least(cap, weight * water) END AS target FROM g),
x AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
r AS (SELECT d.*, x.source_size, x.target, x.whole, x.target - x.whole * x.source_size AS part,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
      FROM d JOIN x ON d.source IS NOT DISTINCT FROM x.source)
SELECT doc_id, size, source_size, target, CAST(size * (whole + CASE WHEN 2 * ahead + size <= 2 * part THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM r"""


@register("op4_source_mixing", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import mixing

    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@register("op2_virtual_slots")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from . import slots

    out = slots.shard(table(spark, sf_dir, "documents"), 8, work_path(spark, "op2-map"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


@register("op3_warc_archive", """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, strlen(payload) AS payload_bytes, sha256(payload) AS payload_digest,
             min(page_id) OVER (PARTITION BY payload) AS owner FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> owner THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> owner THEN owner END AS refers_to FROM d""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import archive

    folder = work_path(spark, "op3-archive")
    archive.write(table(spark, sf_dir, "pages"), folder)
    return archive.read(spark, folder)


@register("op6_line_cleaning")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import lines

    return lines.clean(table(spark, sf_dir, "documents"), with_text=False).drop("clean_text", "lines_removed")


@register("op8_cross_parsing_langid")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import langid

    return langid.identify(table(spark, sf_dir, "documents"))


@register("op7_simhash_blocks")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from . import simhash

    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register("op9_repeat_intervals")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import repeats

    return repeats.Repeats(table(spark, sf_dir, "documents")).report()


@register("op12_lexicon_bpe")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import bpe
    from .tokens import vocabulary_path

    docs, path = table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json")
    return bpe.digests(docs, path, bpe.lexicon(docs, path))


OP13_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM d),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM p, (SELECT unnest([1, 2, 3]) AS k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
t AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
cut AS (SELECT *, unnest(range(1, k)) AS h FROM c),
s AS (SELECT cut.lang, cut.k, cut.phrase, cut.a, cut.h, x.f AS l, y.f AS r,
             CAST(1000000::HUGEINT * cut.a * cut.a // (x.f::HUGEINT * y.f) AS BIGINT) AS score
      FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(w[1:h], ' ') JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(w[h + 1:cut.k], ' ')),
low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, h) = 1),
inner_ AS (SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a AS longer FROM c WHERE k = 3 UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM c WHERE k = 3),
m AS (SELECT lang, phrase, max(longer) AS longer FROM inner_ GROUP BY ALL)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT low.lang, row_number() OVER (PARTITION BY low.lang ORDER BY score DESC, a DESC, encode(low.phrase)) AS rank, low.phrase, a, l, r, t.n, score
  FROM low JOIN t ON t.lang = low.lang LEFT JOIN m ON m.lang = low.lang AND m.phrase = low.phrase
  WHERE NOT (low.k = 2 AND coalesce(100 * m.longer >= 50 * a, false))) WHERE rank <= 2000"""


@register("op13_phrase_streams", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import phrases

    return phrases.mine(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH rows_ AS (SELECT conv_id AS c, turn, sha256(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS said,
                      len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, said) - 1 AS place, said, words FROM rows_),
ids AS (SELECT c, c - c % 20 AS first, CAST(xor(list_reduce(flatten(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda d: [ord(d), 0, 0, 0, 0, 0, 0, 0])),
               lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1)), 4294967295), 4294967295) % 4 AS BIGINT) AS h FROM (SELECT DISTINCT c FROM rows_)),
turns AS (SELECT ids.c, own.place, own.said, own.words FROM ids JOIN own ON own.c = ids.c AND own.place >= ids.h
          UNION ALL SELECT ids.c, own.place, own.said, own.words FROM ids JOIN own ON own.c = ids.first AND own.place < ids.h),
p AS (SELECT c, row_number() OVER w AS depth, list(said) OVER w AS prefix, words FROM turns WINDOW w AS (PARTITION BY c ORDER BY place ROWS UNBOUNDED PRECEDING)
      UNION ALL SELECT c, 0, CAST([] AS VARCHAR[]), 0 FROM ids),
n AS (SELECT depth, prefix, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words FROM p GROUP BY depth, prefix),
kids AS (SELECT prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
full_ AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (prefix)),
below AS (SELECT prefix[1:d] AS prefix, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * words) AS saved
          FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM full_) GROUP BY ALL),
done AS (SELECT c, max_by(prefix, depth) AS prefix FROM p GROUP BY c),
e AS (SELECT prefix, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS ends FROM done GROUP BY prefix)
SELECT f.conv_id, f.depth, up.conv_id AS parent_conv_id, f.n_convs, f.n_children, b.n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
FROM full_ f JOIN below b ON b.prefix = f.prefix LEFT JOIN e ON e.prefix = f.prefix LEFT JOIN n up ON f.depth > 0 AND up.prefix = f.prefix[1:f.depth - 1]"""


@register("op11_zfast_conversations", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import conversations

    return conversations.prefix_trie(table(spark, sf_dir, "conversations"))
