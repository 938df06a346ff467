"""Registered queries of the subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from rivulet.llm import (exact_dedup, html_extract, minhash, mixing, ngram_join, packing, prefix_trie,
                         quality_fm, quality_rules, substring_dedup, token_align, toxicity_gru, url_filter)
from rivulet.llm.common import documents, stored
from rivulet.sources.tables import read_table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages"))


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_fm.classify(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"),
                               meta=quality_fm.META)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_gru.toxicity(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_dedup(documents(spark, sf_dir))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(documents(spark, sf_dir))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(documents(spark, sf_dir))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(documents(spark, sf_dir))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.sequences(read_table(spark, sf_dir, "conversations"))
    return prefix_trie.digested(*prefix_trie.prefix_trie(prefix_trie.grafted(turns)))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    aligned = token_align.align(documents(spark, sf_dir)).withColumn("groups_sha256", digest).drop("groups")
    return token_align.scored(stored(aligned, "aligned"), token_align.piece_count())


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.smallest_ids(ngram_join.ngram_join(documents(spark, sf_dir))[0])


_QUERIES = [op1_packing, op2_url_filter, op3_html_extract, op4_quality_classifier, op5_toxicity,
            op6_near_dedup, op7_substring_dedup, op8_exact_dedup, op9_quality_rules, op10_mixing,
            op11_prefix_trie, op12_token_alignment, op13_ngram_join]

_ORACLE = {
    "op8_exact_dedup": r"""
        with d as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256
                   from documents)
        select doc_id, min(doc_id) over g as keep_id, count(*) over g as group_size,
               doc_id = min(doc_id) over g as kept, text_sha256
        from d window g as (partition by text_sha256)""",
    "op11_prefix_trie": r"""
        with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
                   where conv_id is not null),
        e as (select conv_id, turn, md5(length(role) || ':' || role || text) as dig,
                     len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as words from t),
        own as (select conv_id, list({'dig': dig, 'words': words} order by turn nulls first, dig) as turns
                from e group by conv_id),
        h as (select conv_id, turns, xor(list_reduce(list_prepend(4294967295::bigint,
                         list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint)),
                         lambda crc, c: list_reduce(list_prepend(xor(crc, c), list_transform(range(8), lambda i: 0::bigint)),
                             lambda a, b: xor(a >> 1, 3988292384::bigint * (a & 1)))), 4294967295::bigint) % 4 as h from own),
        paths as (select h.conv_id, list_concat(list_slice(coalesce(b.turns, []), 1, h), list_slice(h.turns, h + 1, len(h.turns)))
                         as turns
                  from h left join own b on b.conv_id = h.conv_id - h.conv_id % 20),
        members as (select conv_id, d.depth, len(turns) as length,
                       md5(array_to_string(list_transform(list_slice(turns, 1, d.depth), lambda x: x.dig), '')) as key,
                       case when d.depth = 0 then '' else md5(array_to_string(
                           list_transform(list_slice(turns, 1, d.depth - 1), lambda x: x.dig), '')) end as above,
                       case when d.depth = 0 then 0 else turns[d.depth].words end as words
                    from paths, lateral (select unnest(range(len(turns) + 1)) as depth) d),
        node as (select depth, key, min(conv_id) as conv_id, any_value(above) as above, any_value(words) as words,
                    count(*) as n_convs, sha256(coalesce(string_agg(case when length = depth then conv_id::varchar end, ','
                        order by conv_id), '')) as ends_sha256 from members group by depth, key),
        kids as (select depth - 1 as depth, above as key, count(*) as n_children from node where depth > 0 group by all),
        own_part as (select node.*, coalesce(n_children, 0) as n_children from node left join kids using (depth, key)),
        below as (select m.depth, m.key, count(*) filter (where v.n_children = 0) as n_leaves,
                     sum((v.n_convs - 1) * v.words) as saved_tokens
                  from own_part v join members m on m.conv_id = v.conv_id and m.depth <= v.depth group by all)
        select v.conv_id, v.depth::bigint as depth, p.conv_id as parent_conv_id, v.n_convs, v.n_children, n_leaves,
               saved_tokens::bigint as saved_tokens, v.ends_sha256
        from own_part v join below using (depth, key) left join node p on p.depth = v.depth - 1 and p.key = v.above""",
    "op13_ngram_join": r"""
        with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
        s as (select doc_id, unnest(list_distinct(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
                  else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end)) as g
              from d),
        o as (select *, count(*) over (partition by doc_id) as n, row_number() over (partition by doc_id order by md5(g)) as r
              from s),
        c as (select distinct a.doc_id as a, b.doc_id as b, a.n as na, b.n as nb from o a join o b on a.g = b.g
              where a.doc_id < b.doc_id and a.r <= a.n - ceil(0.9 * a.n) + 1 and b.r <= b.n - ceil(0.9 * b.n) + 1
                and 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)),
        l as (select c.a, c.b from c join s x on x.doc_id = c.a join s y on y.doc_id = c.b and y.g = x.g
              group by c.a, c.b, c.na, c.nb having 100 * count(*) >= 90 * (c.na + c.nb - count(*))),
        e as (select a, b from l union all select b, a from l),
        r as (select doc_id, doc_id as other from d union select r.doc_id, e.b from r join e on e.a = r.other)
        select doc_id, (select count(*) from s where s.doc_id = r.doc_id) as n_shingles, min(other) as component_id
        from r group by doc_id""",
    "op10_mixing": r"""
        with d as (select doc_id, lang, source,
                 case when source is null then null
                      when regexp_extract(source, '([0-9]{1,9})$', 1) = '' then 'other'
                      else 'domain' || (cast(regexp_extract(source, '([0-9]{1,9})$', 1) as int) % 4) end as domain,
                 len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as n_tokens
              from documents),
        leaf as (select domain, lang, source, sum(n_tokens)::bigint as supply, sum(n_tokens) * 4.0::double as cap
                 from d group by all),
        w1 as (select domain, sum(cap)::double as cap,
                 case domain when 'domain0' then 4.0 when 'domain1' then 3.0 when 'domain2' then 2.0 else 1.0 end::double as w,
                 (select least(sum(cap), sum(supply))::double from leaf) as give from leaf group by domain),
        l1 as (select *, (give - coalesce(sum(cap) over (order by cap / w, domain nulls first
                            rows between unbounded preceding and 1 preceding), 0))
                         / sum(w) over (order by cap / w, domain nulls first
                            rows between current row and unbounded following) as lev from w1),
        g1 as (select domain, case when cap / w <= lev then cap
                 else w * max(case when cap / w > lev then lev end) over () end as give from l1),
        w2 as (select leaf.domain, lang, sum(cap)::double as cap,
                 case lang when 'en' then 11.0 when 'de' then 3.0 when 'fr' then 3.0 when 'es' then 3.0 else 1.0 end::double as w,
                 any_value(give) as give
               from leaf join g1 on leaf.domain is not distinct from g1.domain group by leaf.domain, lang),
        l2 as (select *, (give - coalesce(sum(cap) over (partition by domain order by cap / w, lang nulls first
                            rows between unbounded preceding and 1 preceding), 0))
                         / sum(w) over (partition by domain order by cap / w, lang nulls first
                            rows between current row and unbounded following) as lev from w2),
        g2 as (select domain, lang, case when cap / w <= lev then cap
                 else w * max(case when cap / w > lev then lev end) over (partition by domain) end as give from l2),
        w3 as (select leaf.domain, leaf.lang, source, supply, cap::double as cap, 1.0::double as w, give
               from leaf join g2 on leaf.domain is not distinct from g2.domain and leaf.lang is not distinct from g2.lang),
        l3 as (select *, (give - coalesce(sum(cap) over (partition by domain, lang order by cap / w, source nulls first
                            rows between unbounded preceding and 1 preceding), 0))
                         / sum(w) over (partition by domain, lang order by cap / w, source nulls first
                            rows between current row and unbounded following) as lev from w3),
        g3 as (select domain, lang, source, supply, floor(1e-6 + case when cap / w <= lev then cap
                 else w * max(case when cap / w > lev then lev end) over (partition by domain, lang) end)::bigint as quota from l3),
        p as (select *, case when supply > 0 then quota // supply else 0 end as epochs from g3),
        k as (select d.*, epochs, quota - epochs * supply as rest,
                 md5('17:' || epochs || ':' || doc_id) as key
              from d join p on d.domain is not distinct from p.domain and d.lang is not distinct from p.lang
                            and d.source is not distinct from p.source),
        c as (select *, sum(n_tokens) over (partition by domain, lang, source order by key
                            range between unbounded preceding and current row) as upto from k),
        n as (select *, epochs + case when rest > 0 and key <= coalesce(max(case when upto <= rest then key end)
                            over (partition by domain, lang, source), '') then 1 else 0 end as copies from c)
        select doc_id, domain, lang, source, n_tokens::bigint as n_tokens, e.epoch::bigint as epoch
        from n, lateral (select unnest(range(copies)) as epoch) e""",
}


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of ``corpus_pipeline`` over ``documents``."""
    return corpus_pipeline.run(spark, sf_dir)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in [*_QUERIES, pipeline]}


def oracles() -> dict[str, str]:
    return dict(_ORACLE)
