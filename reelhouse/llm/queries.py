"""The operators as queries over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm import (
    conversations,
    exact,
    language_crf,
    line_rules,
    log_bilinear,
    mixing,
    near,
    packing,
    prefix_trie,
    quality_gam,
    signatures,
    substrings,
    suffix_arrays,
)
from reelhouse.llm.text import documents, fold

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


def op1_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judge(documents(spark, sf_dir))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.formatted(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.with_copies(documents(spark, sf_dir).select("doc_id", "text", "source"))
    return drawn.select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_copies") * F.col("_size")).alias("taken"),
    )


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.components(documents(spark, sf_dir))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removals(documents(spark, sf_dir)).drop("removed")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = quality_gam.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_gam.scored(docs, model).select(
        "doc_id",
        (fold(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= quality_gam.THRESHOLD).cast("int").alias("predicted"),
    )


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = language_crf.train(docs)
    return language_crf.identified(docs.select("doc_id", "text"), model).select(
        "doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score"
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(documents(spark, sf_dir))
    return packing.pack(cut, carry={"ids_crc32": F.crc32("ids")})


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return log_bilinear.scored(docs, log_bilinear.learned_from(docs)).withColumn(
        "held_out", fold(F.col("doc_id"), 5) == 1
    )


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.duplicate_groups(documents(spark, sf_dir))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signatures.ranked(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_arrays.hits(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, span: n + span["end"] - span["start"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


QUERIES = {
    "op1_line_frequency": op1_line_frequency,
    "op2_chat_format": op2_chat_format,
    "op3_mixing": op3_mixing,
    "op4_near_dedup": op4_near_dedup,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_quality": op6_quality,
    "op7_language": op7_language,
    "op8_packing": op8_packing,
    "op9_lm_score": op9_lm_score,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_lexical_search": op12_lexical_search,
    "op13_decontamination": op13_decontamination,
}

SQL = {
    "op1_line_frequency": rf"""
        with d as (select doc_id, source, coalesce(text, '') as text, {_WORDS} as w from documents),
        grams as (
            select doc_id, pos, w[pos] || ' ' || w[pos + 1] || ' ' || w[pos + 2] as gram
            from (select doc_id, w, unnest(range(1, len(w) - 1)) as pos from d)
        ),
        twice as (
            select doc_id, pos from grams
            qualify count(*) over (partition by doc_id, gram) > 1
        ),
        covered as (
            select doc_id, count(distinct p) as n_repeat_words
            from (select doc_id, unnest([pos, pos + 1, pos + 2]) as p from twice) group by doc_id
        ),
        lines as (
            select doc_id, source, text, line,
                trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[\x20\x09-\x0D]+', ' ', 'g'), ' ') as plain
            from (select doc_id, source, text, unnest(string_split(text, chr(10))) as line from d)
        ),
        worded as (select * from lines where plain <> ''),
        dup as (select doc_id, count(*) - count(distinct line) as n_dup_lines from worded group by doc_id),
        hosts as (select source, count(distinct coalesce(text, '')) as n from documents group by source),
        often as (
            select w.source, plain from worded w join hosts h on w.source is not distinct from h.source
            group by w.source, plain, h.n
            having count(distinct text) > {line_rules.LEAST_DOCS}
                and count(distinct text) > h.n * {line_rules.SHARE_OF_HOST}
        ),
        removed as (
            select doc_id, sum(len(string_split(w.plain, ' ')))::bigint as n_removed
            from worded w join often o on w.plain = o.plain and w.source is not distinct from o.source
            group by doc_id
        ),
        counts as (
            select d.doc_id, len(w)::bigint as n_words,
                length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
                (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
                coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
                coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
                coalesce(n_removed, 0)::bigint as n_removed
            from d left join dup using (doc_id) left join covered using (doc_id) left join removed using (doc_id)
        ),
        judged as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counts)
        select *, not base_failed and n_removed <= {line_rules.MOST_REMOVED} * n_words as kept from judged
    """,
    "op2_chat_format": r"""
        with t as (
            select distinct conv_id, case when conv_id is null then coalesce('+' || role, '-') || chr(31) || coalesce('+' || text, '-') end as alone,
                case when conv_id is not null then turn end as turn, role, text
            from conversations
        ),
        o as (
            select *, unhex(md5(coalesce('+' || role, '-') || chr(31) || coalesce('+' || text, '-'))) as content from t
        ),
        c as (
            select conv_id, alone,
                list({'r': role, 't': text} order by turn nulls first, role nulls first, left(text, 64) nulls first, content) as l,
                string_agg('<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10), ''
                    order by turn nulls first, role nulls first, left(text, 64) nulls first, content) as text
            from o group by conv_id, alone
        ),
        w as (
            select l, min(conv_id) as conv_id, any_value(text) as text, count(*) as n_logged from c group by l
        )
        select w.conv_id, len(w.l)::bigint as n_turns, n_logged, text
        from w where not exists (select 1 from c as o where len(o.l) > len(w.l) and o.l[1:len(w.l)] = w.l)
    """,
    "op3_mixing": rf"""
        with d as (select doc_id, source, len({_WORDS})::bigint as size from documents),
        s as (
            select source, source_size, [5.0, 2.0, 1.0][(row_number() over (order by source nulls last) - 1) % 3 + 1]::double as weight,
                source_size * 2.0::double as cap
            from (select source, sum(size)::bigint as source_size from d group by source)
        ),
        l as (
            select *, (sum(source_size) over () * 1.5::double - coalesce(sum(cap) over (
                    order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))
                / sum(weight) over (order by cap / weight, source nulls last rows between current row and unbounded following) as level
            from s
        ),
        t as (
            select source, source_size, least(cap, coalesce(
                max(case when level <= cap / weight then level end) over () * weight, cap)) as target
            from l
        ),
        r as (select *, case when source_size > 0 then target / source_size else 0 end as rate from t)
        select doc_id, size, source_size, target,
            (size * (floor(rate) + (
                ('0x' || substr(sha256('mix-' || coalesce(doc_id::varchar, '')), 1, 8))::bigint / 4294967296.0::double
                < rate - floor(rate))::int))::bigint as taken
        from d join r on d.source is not distinct from r.source
    """,
    "op4_near_dedup": r"""
        with recursive d as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
            from documents
        ),
        s as (
            select distinct doc_id, md5(array_to_string(w[p:p + 4], ' ')) as g
            from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as p from d where len(w) > 0)
        ),
        n as (select doc_id, count(*) as n_shingles from s group by doc_id),
        links as (
            select a.doc_id as a, b.doc_id as b
            from s a join s b on a.g = b.g and a.doc_id < b.doc_id
            join n na on na.doc_id = a.doc_id join n nb on nb.doc_id = b.doc_id
            group by a.doc_id, b.doc_id, na.n_shingles, nb.n_shingles
            having 100 * count(*) >= 75 * (na.n_shingles + nb.n_shingles - count(*))
        ),
        edges as (select a, b from links union all select b, a from links),
        reach as (
            select doc_id as start, doc_id as reached from d
            union
            select r.start, e.b from reach r join edges e on e.a = r.reached
        ),
        least as (select start, min(reached) as component_id from reach group by start)
        select doc_id, coalesce(n_shingles, 0)::bigint as n_shingles, component_id, doc_id = component_id as kept
        from d left join n using (doc_id) join least on start = doc_id
    """,
    "op5_substring_dedup": r"""
        with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
        wins as (
            select doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) as h
            from (select doc_id, w, unnest(range(1, len(w) - 48)) as p from d where len(w) >= 50)
        ),
        again as (select doc_id, p from wins qualify doc_id > min(doc_id) over (partition by h)),
        gone as (select distinct doc_id, p + o as p from again, range(0, 50) as r(o)),
        marks as (select doc_id, p, w[p] as word from (select doc_id, w, unnest(range(1, len(w) + 1)) as p from d)),
        kept as (
            select m.doc_id, count(g.p) as n_removed,
                coalesce(string_agg(case when g.p is null then word end, ' ' order by m.p), '') as t
            from marks m left join gone g on g.doc_id = m.doc_id and g.p = m.p group by m.doc_id
        )
        select doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed,
            sha256(coalesce(t, '')) as kept_sha256
        from d left join kept using (doc_id)
    """,
    "op10_exact_dedup": r"""
        with d as (
            select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents
        )
        select doc_id, min(doc_id) over g as keep_id, count(*) over g as group_size,
            doc_id = min(doc_id) over g as kept, sha256(t) as text_sha256
        from d window g as (partition by t)
    """,
    "op11_prefix_trie": r"""
        with t as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
            from conversations where conv_id is not null
        ),
        c as (
            select conv_id, list({'r': role, 't': text} order by turn nulls first, role, left(text, 64),
                md5(length(role) || ':' || role || text)) as l
            from t group by conv_id
        ),
        h as (
            select *, xor(4294967295, list_reduce(list_prepend(4294967295, [ord(x)::bigint for x in string_split(conv_id::varchar, '')]),
                lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
                    lambda v, _: xor(v >> 1, 3988292384 * (v & 1))))) % 6 as h
            from c
        ),
        r as (
            select a.conv_id, list_concat(coalesce(b.l, [])[1:a.h], a.l[a.h + 1:]) as l
            from h a left join c b on b.conv_id = a.conv_id - a.conv_id % 100
        ),
        p as (select conv_id, l[1:d] as k, d, len(l) = d as ends from (select conv_id, l, unnest(range(0, len(l) + 1)) as d from r)),
        n as (
            select k, d, min(conv_id) as conv_id, count(*) as n_convs,
                coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends), '') as ids
            from p group by k, d
        ),
        kids as (select k[1:d - 1] as k, count(*) as n_children from n where d > 0 group by 1),
        v as (
            select n.*, coalesce(n_children, 0) as n_children, case when d > 0 then (n_convs - 1) * length(k[d].t) else 0 end as saved
            from n left join kids using (k)
        ),
        under as (
            select u, count(*) filter (where n_children = 0) as n_leaves, sum(saved)::bigint as saved_tokens
            from (select k[1:e] as u, n_children, saved from (select k, n_children, saved, unnest(range(0, d + 1)) as e from v))
            group by u
        )
        select v.conv_id, v.d as depth, case when v.d > 0 then o.conv_id end as parent_conv_id, v.n_convs, v.n_children,
            n_leaves, saved_tokens, sha256(v.ids) as ends_sha256
        from v join under on under.u = v.k left join n o on o.k = v.k[1:v.d - 1] and o.d = v.d - 1
    """,
    "op12_lexical_search": rf"""
        with d as (select row_number() over () as row, doc_id, {_TERMS} as w from documents),
        i as (
            select row_number() over () as item, item_id, {_TERMS} as w
            from (select distinct item_id, text from benchmark)
        ),
        totals as (select count(*)::bigint as n_docs, sum(len(w))::bigint as n_terms from d where len(w) > 0),
        asked as (select item, term, count(*)::bigint as times from (select item, unnest(w) as term from i) group by item, term),
        held as (
            select row, doc_id, term, len(w)::bigint as n, count(*)::bigint as tf
            from (select row, doc_id, w, unnest(w) as term from d)
            where term in (select term from asked) group by row, doc_id, term, len(w)
        ),
        weights as (
            select term, floor(1000 * ln((2 * any_value(n_docs) + 2)::double / (2 * count(*) + 1)))::bigint as weight
            from held cross join totals group by term
        ),
        scores as (
            select item, row, doc_id, sum(times * weight *
                ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::bigint as score
            from held join asked using (term) join weights using (term) cross join totals group by item, row, doc_id
        ),
        best as (
            select *, row_number() over (partition by item order by score desc, doc_id nulls last)::int as rank
            from scores where score > 0
        )
        select item_id, rank, doc_id, score from best join i using (item) where rank <= 10
    """,
    "op13_decontamination": rf"""
        with d as (select row_number() over () as row, doc_id, {_TERMS} as w from documents),
        i as (select item_id::varchar as item, {_TERMS} as w from benchmark),
        tests as (
            select distinct item, unnest([w[p:p + 9] for p in range(1, greatest(len(w) - 9, 1) + 1)]) as run
            from i where len(w) > 0
        ),
        sizes as (select distinct len(run)::bigint as k from tests),
        wins as (
            select row, p, k, array_to_string(w[p:p + k - 1], ' ') as run
            from (select row, w, k, unnest(range(1, len(w) - k + 2)) as p from d cross join sizes where len(w) >= k)
        ),
        found as (
            select row, p, k, item from wins
            join (select item, array_to_string(run, ' ') as run from tests) using (run)
        ),
        words as (
            select row, count(distinct q) as n_hit
            from (select row, unnest(range(p, p + k)) as q from found) group by row
        ),
        named as (
            select row, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items
            from found group by row
        )
        select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
            coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
            coalesce(n_hit, 0) > 0 as contaminated
        from d left join words using (row) left join named using (row)
    """,
}
