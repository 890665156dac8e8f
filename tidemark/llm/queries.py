"""The operators as named queries over whole tables, with the result columns of their contracts."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import collocations, merkle, near_dedup, packing, pieces, pii, quality_rules, secrets_scan, sharding, token_counts, topk, toxicity, warc

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 16


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer file lies, the same on all machines; TIDEMARK_TOKENIZERS names another folder."""
    folder = os.environ.get("TIDEMARK_TOKENIZERS")
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return str(public_tokenizers.path(name))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_rules(documents(spark, folder))


def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_pii(documents(spark, folder))
    base = F.filter("spans", lambda s: s["base"])
    text = lambda spans: F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    )
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(k) for k in pii.KINDS], F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans")
    )


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return toxicity.score(docs, toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet")))


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets_scan.find_secrets(documents(spark, folder))
    base = tuple(r.kind for r in secrets_scan.BASE_RULES)
    every = tuple(r.kind for r in secrets_scan.RULES)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(kind) for kind in base],
        F.sha2(secrets_scan.digest(F.col("spans"), base), 256).alias("base_sha256"),
        secrets_scan.digest(F.col("spans"), every).alias("spans"),
    )


def op5_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """The ids of every text, and whether decoding them gives the text back."""
    model = tokenizer_path("piece_bpe_32k.model")
    docs = documents(spark, folder).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keyed = docs.select(F.struct("doc_id", F.xxhash64("text").alias("h")).alias("key"), "text")
    return pieces.encode_and_decode(keyed, model, id_column="key").select(
        "key.doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        F.crc32(F.col("decoded").cast("binary")).alias("decoded_crc32"),
        (F.xxhash64("decoded") == F.col("key.h")).alias("round_trip"),
        "ids",
    )


def op6_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search(spark.read.parquet(f"{folder}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


OP6_SQL = """
with v as (
    select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as q
    from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
    select a.vec_id as query_id, b.vec_id as vec_id,
           cast(list_sum(list_transform(list_zip(a.q, b.q), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))) as bigint) as score
    from v a join v b on a.vec_id <> b.vec_id
    where a.vec_id % 100 = 0
)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
from s qualify rank <= 10
"""


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, folder), tokenizer_path("byte_bpe_50k.json"))


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(documents(spark, folder), tokenizer_path("word_bpe_49k.json")).drop("sequence_length")


def op9_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, folder))


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign(documents(spark, folder), [1.0] * SHARDS)


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(documents(spark, folder))


OP11_SQL = """
with pieces as (
    select row_number() over () as id, lang, piece
    from (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[.,;:!?\\x0A-\\x0D]')) as piece
          from documents)
), words as (
    select id, lang, unnest(w) as w, generate_subscripts(w, 1) as i
    from (select id, lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from pieces)
), suffixes as (
    select lang, w as a, lead(w) over p as b, lead(w, 2) over p as c
    from words window p as (partition by id order by i)
), f1 as (select lang, a as p, count(*) as f from suffixes group by all
), f2 as (select lang, a, b, a || ' ' || b as p, count(*) as f from suffixes where b is not null group by all
), f3 as (select lang, a, b, c, a || ' ' || b || ' ' || c as p, count(*) as f from suffixes where c is not null group by all
), cuts as (
    select lang, 2 as size, p, f, 1 as k, a as first, b as rest from f2 where f >= 10
    union all select lang, 3, p, f, 1, a, b || ' ' || c from f3 where f >= 10
    union all select lang, 3, p, f, 2, a || ' ' || b, c from f3 where f >= 10
), parts as (select lang, p, f from f1 union all select lang, p, f from f2
), scored as (
    select c.lang, size, c.p, c.f as a, k, x.f as l, y.f as r,
           cast((1000000 * c.f::hugeint * c.f::hugeint) // (x.f::hugeint * y.f::hugeint) as bigint) as score
    from cuts c
    join parts x on x.lang = c.lang and x.p = c.first
    join parts y on y.lang = c.lang and y.p = c.rest
    qualify row_number() over (partition by c.lang, c.p order by score, k) = 1
), inside as (
    select lang, p, max(f) as f
    from (select lang, unnest([a || ' ' || b, b || ' ' || c]) as p, f from f3 where f >= 10) group by all
)
select s.lang, row_number() over (partition by s.lang order by score desc, a desc, s.p) as rank, s.p as phrase, a, l, r, n, score
from scored s
left join inside i on s.size = 2 and i.lang = s.lang and i.p = s.p
join (select lang, cast(sum(f) as bigint) as n from f1 group by lang) t on t.lang = s.lang
where i.f is null or 100 * i.f < 50 * a
qualify rank <= 2000
"""


def op12_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived(spark.read.parquet(f"{folder}/pages.parquet"))


OP12_SQL = """
with p as (
    select page_id, body, sha1(body) as h,
           row_number() over (partition by body order by page_id desc nulls last) as k,
           max(page_id) over (partition by body) as top
    from (select page_id, coalesce(html, '') as body from pages)
)
select page_id, cast(strlen(body) as bigint) as payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + cast(
           (cast('0x' || substr(h, cast(5 * (i // 4) + 1 as bigint), 5) as bigint) >> cast(15 - 5 * (i % 4) as bigint)) & 31 as bigint), 1)),
           'string_agg', '') as payload_digest,
       case when k = 1 then 'response' else 'revisit' end as record_type,
       case when k > 1 then top end as refers_to
from p
"""


def _tree_sql(name: str, leaves: str, levels: int) -> list[str]:
    """Tables for the trees over ``leaves`` (tree, p, d, f): per level the nodes, and what each leaf has beside and above it.

    ``{name}`` ends with tree, p, root, proof (siblings, joined) and folded.
    """
    out = [
        f"{name}_n0 as (select tree, p, d, count(*) over (partition by tree is null, tree) as n from {leaves})",
        f"{name}_w0 as (select tree, p, '' as proof, f as folded from {leaves})",
    ]
    for k in range(levels):
        out += [
            f"""{name}_r{k} as materialized (select tree, p // 8 as p, list(d order by p) as ds, any_value(n) as n
                from {name}_n{k} group by tree, p // 8)""",
            f"""{name}_n{k + 1} as (select tree, p, case when n = 1 then ds[1] else sha256(array_to_string(ds, '')) end as d,
                count(*) over (partition by tree is null, tree) as n from {name}_r{k})""",
            f"""{name}_w{k + 1} as (
                select w.tree, w.p, w.proof || case when r.n = 1 then '' else a || b end as proof,
                       case when r.n = 1 then w.folded else sha256(a || w.folded || b) end as folded
                from (select w.*, w.p // {8 ** (k + 1)} as up, w.p // {8**k} % 8 as place from {name}_w{k} w) w
                join (select * from {name}_r{k}) r on r.tree is not distinct from w.tree and r.p = w.up,
                lateral (select coalesce(array_to_string(r.ds[1 : place], ''), '') as a,
                                coalesce(array_to_string(r.ds[place + 2 :], ''), '') as b))""",
        ]
    out.append(
        f"""{name} as (select w.tree, w.p, w.proof, w.folded, n.d as root
            from {name}_w{levels} w join {name}_n{levels} n on n.tree is not distinct from w.tree)"""
    )
    return out


def _op13_sql() -> str:
    """Up to 8 ** 6 rows a group and 8 ** 3 groups."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    digest = lambda text: "sha256(" + " || ".join(
        f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in ("cast(doc_id as varchar)", "source", "lang", "cast(n_chars as varchar)", text)
    ) + ")"
    steps = ", ".join(["-1"] * 8)
    crc = f"""xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split(cast(doc_id as varchar), ''),
        lambda c: [ord(c)::bigint, {steps}]))), lambda s, x: case when x >= 0 then xor(s, x)
        when s & 1 = 1 then xor(s >> 1, 3988292384::bigint) else s >> 1 end), 4294967295::bigint)"""
    forged = digest(f"translate(text, '{upper}', '{upper.lower()}')")
    tables = [
        f"""leaves as materialized (select doc_id, lang as tree, d, case when hit then forged else d end as f,
            row_number() over (partition by lang is null, lang order by doc_id nulls first, d) - 1 as p
            from (select doc_id, lang, {digest('text')} as d, {forged} as forged, doc_id is not null and {crc} % 3 = 0 as hit from documents))""",
        *_tree_sql("inner_", "leaves", 6),
        """subroots as materialized (select 'all' as tree, tree as lang, root as d, '' as f,
            row_number() over (order by tree nulls first) - 1 as p
            from (select distinct tree, root from inner_))""",
        *_tree_sql("over_", "subroots", 3),
    ]
    # the outer steps of every leaf go on from what the inner ones have folded
    body = """select l.doc_id, l.d as leaf, s.d as subroot, o.root, sha256(i.proof || o.proof) as proof_sha256, i.folded, s.p as up
        from leaves l join inner_ i on i.tree is not distinct from l.tree and i.p = l.p
        join subroots s on s.lang is not distinct from l.tree join over_ o on o.p = s.p"""
    folded = [f"f0 as (select *, folded as x from ({body}))"]
    for k in range(3):
        folded.append(
            f"""f{k + 1} as (select f.* exclude (x), case when r.n = 1 then f.x else sha256(
                coalesce(array_to_string(r.ds[1 : f.up // {8**k} % 8], ''), '') || f.x
                || coalesce(array_to_string(r.ds[f.up // {8**k} % 8 + 2 :], ''), '')) end as x
                from f{k} f join over__r{k} r on r.p = f.up // {8 ** (k + 1)})"""
        )
    return f"""with {', '.join(tables + folded)}
        select doc_id, leaf, subroot, root, proof_sha256, x as folded_root, x = root as verified from f3"""


OP13_SQL = _op13_sql()


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(documents(spark, folder))


def all_queries() -> dict[str, Query]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_pii": op2_pii,
        "op3_toxicity": op3_toxicity,
        "op4_secret_scan": op4_secret_scan,
        "op5_pieces": op5_pieces,
        "op6_topk": op6_topk,
        "op7_token_counts": op7_token_counts,
        "op8_packing": op8_packing,
        "op9_near_dedup": op9_near_dedup,
        "op10_sharding": op10_sharding,
        "op11_collocations": op11_collocations,
        "op12_warc": op12_warc,
        "op13_merkle_manifest": op13_merkle_manifest,
    }


def all_checks() -> dict[str, str]:
    return {"op6_topk": OP6_SQL, "op11_collocations": OP11_SQL, "op12_warc": OP12_SQL, "op13_merkle_manifest": OP13_SQL}
