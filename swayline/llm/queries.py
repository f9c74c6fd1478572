"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swayline.llm import (
    collision_ann, licences, maxscore, multiset_hash, packing, pii, prefix_trie, secret_scan, simhash, slice_codes, toxicity, viterbi, warc_zip,
)
from swayline.llm.common import new_path


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def op1_warc_zip(spark: SparkSession, folder: str) -> DataFrame:
    pages = _read(spark, folder, "pages").select(F.col("page_id").alias("key"), F.col("url").alias("uri"), F.col("html").cast("binary").alias("payload"))
    packages = new_path(spark, "packages")
    warc_zip.write_packages(warc_zip.with_revisits(pages), packages)
    number = lambda c: F.regexp_extract(c, r"(-?\d+)$", 1).try_cast("long")
    return warc_zip.read_packages(spark, packages, with_payload=False).select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scan(_read(spark, folder, "documents"))


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_read(spark, folder, "documents"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    model = toxicity.fit(docs, _read(spark, folder, "labels"), usable=~held_out())
    return toxicity.score(docs, model).withColumn("held_out", held_out())


def op5_viterbi(spark: SparkSession, folder: str) -> DataFrame:
    return viterbi.digest(_read(spark, folder, "documents"))


def op6_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(_read(spark, folder, "documents"), licences.known_licences(spark))


def op7_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(_read(spark, folder, "documents"))


def op8_maxscore(spark: SparkSession, folder: str) -> DataFrame:
    return maxscore.exact_top_k(_read(spark, folder, "embeddings"), F.col("key") % 50 == 0)


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, folder, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_collision_ann(spark: SparkSession, folder: str) -> DataFrame:
    return collision_ann.nearest(_read(spark, folder, "embeddings"), F.col("key") % 20 == 0)


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded, books = slice_codes.compress(_read(spark, folder, "embeddings"), carry=["label"])
    return slice_codes.with_group_error(coded, "label", "label_error").select(
        "vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def op12_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return multiset_hash.fingerprints(_read(spark, folder, "documents"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    own = prefix_trie.sequences(_read(spark, folder, "conversations"))
    shared = F.crc32(F.col("conv_id").cast("string")) % 4
    return prefix_trie.nodes(prefix_trie.with_shared_start(own, F.col("conv_id") - F.col("conv_id") % 20, shared.cast("int"), 3))


QUERIES = {f.__name__: f for f in (op1_warc_zip, op2_secret_scan, op3_packing, op4_toxicity, op5_viterbi, op6_licences,
                                   op7_personal_data, op8_maxscore, op9_simhash, op10_collision_ann, op11_vector_codes, op12_fingerprints,
                                   op13_prefix_trie)}



def _dated(c: str) -> str:
    return f"regexp_matches({c}, '^[<{{(\\[]?([0-9][0-9][0-9][0-9]|19yy|yyyy|year)([^a-z0-9_]|$)')"


def _stated(c: str) -> str:
    rest = f"ltrim(substr({c}, 10), ' ,:' || chr(9))"
    signs = " or ".join(f"starts_with({rest}, '{sign}')" for sign in ("(c)", "©", "&copy;"))
    return f"(starts_with({c}, 'copyright') and ({signs} or {_dated(rest)}))"


#: Licence forms line by line with string functions: ``body`` is a line from its first letter or digit on, ``signed`` what follows a sign there.
_FORMS = f"""
        source as (select 'd' as kind, cast(doc_id as varchar) as id, coalesce(text, '') as text from documents
                   union all select 'k', licence_id, text from known_texts),
        cut as (select kind, id, unnest(string_split(lower(text), chr(10))) as line, generate_subscripts(string_split(lower(text), chr(10)), 1) as i from source),
        led as (select *, regexp_replace(line, '^[^a-z0-9]+', '') as body from cut),
        after as (select *, ltrim(case when starts_with(body, 'c)') and ends_with(substr(line, 1, len(line) - len(body)), '(') then substr(body, 3)
                    when starts_with(body, 'copy;') and ends_with(substr(line, 1, len(line) - len(body)), '&') then substr(body, 6)
                    when contains(substr(line, 1, len(line) - len(body)), '©')
                    then list_last(string_split(substr(line, 1, len(line) - len(body)), '©')) || body end, ' ' || chr(9)) as signed from led),
        kept as (select kind, id, string_agg(line, chr(10) order by i) filter (where not (
                {_stated('body')} or coalesce({_stated('signed')} or {_dated('signed')} or contains(signed, 'all rights reserved'), false)
                or (starts_with(body, 'all rights reserved') and not regexp_matches(substr(body, 20), '[a-z0-9]')))) as text from after group by kind, id),
        forms as (select kind, id, {{spelled}} as form from kept)"""
_SPELLED = "trim(regexp_replace(coalesce(text, ''), '[^a-z0-9]+', ' ', 'g'))"
for _spelt, _spelling in licences.SPELLINGS:
    _SPELLED = f"replace({_SPELLED}, '{_spelt}', '{_spelling}')"
_FORMS = _FORMS.replace("{spelled}", _SPELLED)
_QUOTED = ", ".join("('{}', '{}')".format(k.replace("'", "''"), v.replace("'", "''")) for k, v in sorted(licences.KNOWN.items()))



def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Codebooks round by round, every distance taken: no slices, no masks."""
    steps = [f"""
        k as materialized (select vec_id, label, list_transform(embedding, lambda x: cast(floor(4096 * cast(x as double)) as bigint)) as v from embeddings
            where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        x as materialized (select vec_id, label, p, list_slice(v, p * (len(v) // {parts}) + 1, (p + 1) * (len(v) // {parts})) as s from k, range({parts}) as t(p)),
        c0 as materialized (select p, row_number() over (partition by p order by vec_id) - 1 as e, s from x
            qualify row_number() over (partition by p order by vec_id) <= {entries})"""]
    for r in range(rounds + 1):
        steps.append(f"""
        a{r} as materialized (select x.vec_id, any_value(x.label) as label, x.p, any_value(x.s) as s, min(struct_pack(d := cast(list_sum(list_transform(
            list_zip(x.s, c.s), lambda q: (q[1] - q[2]) * (q[1] - q[2]))) as bigint), e := c.e)) as near from x join c{r} c on x.p = c.p group by x.vec_id, x.p)""")
        if r < rounds:
            steps.append(f"""
        n{r} as (select p, e, list(((total - ((total % n) + n) % n) // n)::bigint order by i) as s from (
            select p, near.e as e, i, sum(s[i]) as total, count(*) as n from a{r}, range(1, 1000) as t(i) where i <= len(s) group by all) group by p, e),
        c{r + 1} as materialized (select c.p, c.e, coalesce(n.s, c.s) as s from c{r} c left join n{r} n on c.p = n.p and c.e = n.e)""")
    return "with " + ",".join(steps) + f""",
        r as (select vec_id, any_value(label) as label, string_agg(lower(format('{{:02x}}', near.e)), '' order by p) as code, cast(sum(near.d) as bigint) as error
              from a{rounds} group by vec_id)
        select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
               (select sha256(string_agg(array_to_string(s, ','), ',' order by p, e)) from c{rounds}) as codebooks_sha256 from r"""


_CRC32 = """list_reduce([4294967295] || list_transform(string_split(cast(conv_id as varchar), ''), lambda d: cast(ascii(d) as bigint)),
    lambda c, b: list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end))"""

ORACLE = {
    "op1_warc_zip": """
        with p as (select page_id, coalesce(html, '') as html from pages),
             d as (select page_id, cast(strlen(html) as bigint) as payload_bytes, sha1(html) as payload_digest from p),
             k as (select payload_digest, max(page_id) as kept from d where payload_bytes >= 1000 group by 1)
        select page_id, payload_bytes, payload_digest,
               case when kept is null or page_id = kept then 'response' else 'revisit' end as record_type,
               case when page_id <> kept then kept end as refers_to
        from d left join k using (payload_digest)""",
    "op6_licences": f"""
        with known_texts as (select * from (values {_QUOTED}) as t(licence_id, text)), {_FORMS},
             known as (select min(id) as licence_id, sha256(form) as canonical_sha256 from forms where kind = 'k' and form <> '' group by 2)
        select d.doc_id, sha256(f.form) as canonical_sha256, k.licence_id
        from documents d join forms f on f.kind = 'd' and f.id = cast(d.doc_id as varchar) left join known k on k.canonical_sha256 = sha256(f.form)""",
    "op8_maxscore": """
        with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as t from embeddings),
             s as (select q.vec_id as query_id, r.vec_id,
                          cast(list_sum(list_transform(list_zip(q.t, r.t), lambda p: p[1] * p[2])) as bigint) as score
                   from v q join v r on q.vec_id <> r.vec_id where q.vec_id % 50 = 0),
             r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s)
        select query_id, rank, vec_id, score from r where rank <= 5""",
    "op11_vector_codes": _codes_sql(),
    "op13_prefix_trie": f"""
        with t as (select conv_id, turn, coalesce(role, '') as r, coalesce(text, '') as x from conversations where conv_id is not null),
             o as (select conv_id, list(struct_pack(i := substr(sha256(sha256(r) || sha256(x)), 1, 32), r := r, x := x)
                          order by turn nulls first, substr(sha256(sha256(r) || sha256(x)), 1, 32)) as own from t group by conv_id),
             h as (select conv_id, own, cast(xor({_CRC32}, 4294967295) % 4 as bigint) as h from o),
             b as materialized (select h.conv_id, coalesce(list_slice(f.own, 1, h.h), []) || list_slice(h.own, h.h + 1, len(h.own)) as turns
                  from h left join o f on f.conv_id = h.conv_id - h.conv_id % 20),
             m as materialized (select conv_id, d, min(conv_id) over (partition by d, list_slice(turns, 1, d)) as node, len(turns) as size, turns[d].x as x
                  from (select *, unnest(range(0, len(turns) + 1)) as d from b)),
             n as materialized (select node, d, count(*) as n_convs, len(regexp_extract_all(coalesce(any_value(x), ''), '[^\\x20\\x09-\\x0D]+')) as words,
                         sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where size = d), '')) as ends_sha256 from m group by node, d),
             c as (select n.*, u.node as up, u.d as up_d from n left join m u on u.conv_id = n.node and u.d = n.d - 1),
             k as materialized (select node, d, (select count(*) from c where c.up = n.node and c.up_d = n.d) as n_children from n),
             s as (select a.node, a.d, sum(cast(k.n_children = 0 as bigint)) as n_leaves, sum((n.n_convs - 1) * n.words) as saved_tokens
                   from n join k on k.node = n.node and k.d = n.d join m a on a.conv_id = n.node and a.d <= n.d group by a.node, a.d)
        select c.node as conv_id, c.d as depth, c.up as parent_conv_id, c.n_convs, k.n_children, cast(s.n_leaves as bigint) as n_leaves,
               cast(s.saved_tokens as bigint) as saved_tokens, c.ends_sha256
        from c join k on k.node = c.node and k.d = c.d join s on s.node = c.node and s.d = c.d""",
}
