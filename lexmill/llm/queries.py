"""The thin queries over the operators of this subpackage, with production parameters, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import licenses


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexmill.llm import bpe, packing

    path = _tokenizer()
    return packing.pack_documents(spark, _table(spark, sf_dir, "documents"), lambda: bpe.encoder(path), capacity=2048)


def op2_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexmill.llm import warc

    return warc.read_archives(warc.write_archives(_table(spark, sf_dir, "pages")))


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexmill.llm import bpe

    return bpe.round_trip(_table(spark, sf_dir, "documents"), _tokenizer())


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexmill.llm import ann

    return ann.search(_table(spark, sf_dir, "embeddings"), every=20, k=20)


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexmill.llm import jaccard

    out = jaccard.near_duplicate_components(_table(spark, sf_dir, "documents"), size=3, threshold="9/10")
    return out.select("doc_id", "n_shingles", "component_id")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexmill.llm import substring

    return substring.repeated_passages(_table(spark, sf_dir, "documents"), window=50)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexmill.llm import quality

    documents = _table(spark, sf_dir, "documents")
    return quality.judge(documents, quality.train(documents, _table(spark, sf_dir, "labels")))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexmill.llm import html

    return html.main_text(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexmill.llm import lm

    return lm.score_documents(_table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexmill.llm import langid

    return langid.identify(_table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexmill.llm import fim

    made = fim.fill_in_middle(_table(spark, sf_dir, "documents"), seed=42, rate=50, spm_rate=80)
    text = fim.restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexmill.llm import phrases

    return phrases.collocations(_table(spark, sf_dir, "documents"), most=5, least=100, share=100, top=2000)


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexmill.llm import licenses

    return licenses.scan(_table(spark, sf_dir, "documents")).drop("matches")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_best_fit_packing,
            op2_warc_archive,
            op3_bpe_round_trip,
            op4_nearest_neighbours,
            op5_ngram_jaccard_join,
            op6_substring_dedup,
            op7_quality_rules,
            op8_html_extraction,
            op9_lm_scoring,
            op10_language_id,
            op11_fill_in_middle,
            op12_phrase_collocations,
            op13_license_scan,
        )
    }


_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"


def _values(pairs) -> str:
    return ", ".join(f"('{a}', '{b}')" for a, b in pairs)


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = {
    "op2_warc_archive": """
        with p as (select page_id, strlen(coalesce(html, '')) as n, sha1(coalesce(html, '')) as d from pages),
        r as (select d, max(page_id) as first from p where n >= 1000 group by d)
        select page_id, n::bigint as payload_bytes, p.d as payload_digest,
               case when page_id < first then 'revisit' else 'response' end as record_type,
               case when page_id < first then first end as refers_to
        from p left join r on p.d = r.d and n >= 1000
        """,
    "op5_ngram_jaccard_join": f"""
        with recursive w as (select doc_id, {_WORDS.format(_LOWER)} as w from documents),
        s as (select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
              else list_transform(generate_series(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) as g from w),
        n as (select doc_id, count(*) as n from s group by 1),
        o as (select x.doc_id as a, y.doc_id as b, count(*) as o from s x join s y on x.g = y.g and x.doc_id < y.doc_id group by 1, 2),
        l as (select a, b from o join n x on x.doc_id = a join n y on y.doc_id = b where 100 * o >= 90 * (x.n + y.n - o)),
        e as (select a, b from l union all select b, a from l),
        r as (select a, b as z from e union select r.a, e.b from r join e on r.z = e.a),
        c as (select a, min(z) as low from r group by 1)
        select w.doc_id, coalesce(n.n, 0)::bigint as n_shingles, least(w.doc_id, coalesce(c.low, w.doc_id)) as component_id
        from w left join n using (doc_id) left join c on c.a = w.doc_id
        """,
    "op6_substring_dedup": f"""
        with w as (select doc_id, {_WORDS.format("text")} as w from documents),
        p as (select doc_id, unnest(generate_series(1, len(w) - 49)) as p, w from w where len(w) >= 50),
        h as (select doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) as h from p),
        f as (select h, min(doc_id) as first from h group by 1),
        gone as (select distinct doc_id, unnest(generate_series(p, p + 49)) as p from h join f using (h) where first < doc_id),
        g as (select doc_id, list(p) as gone from gone group by 1)
        select w.doc_id, len(w.w)::bigint as n_words, coalesce(len(gone), 0)::bigint as n_removed,
               sha256(array_to_string(case when gone is null then w.w
                   else list_filter(w.w, lambda x, i: not list_contains(gone, i)) end, ' ')) as kept_sha256
        from w left join g using (doc_id)
        """,
    "op11_fill_in_middle": r"""
        with t as (select doc_id, coalesce(text, '') as x, sha256('42:' || coalesce(doc_id::varchar, 'null')) as h from documents),
        d as (select *, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2, ('0x' || h[17:24])::bigint as h3,
              ('0x' || h[25:32])::bigint as h4, regexp_extract_all(x, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as u from t),
        f as (select *, len(u)::bigint as n, case when x = '' or contains(x, '<P>') or contains(x, '<S>') or contains(x, '<M>') or h3 % 100 >= 50
              then 'plain' when h4 % 100 < 80 then 'spm' else 'psm' end as form from d),
        c as (select *, least(h1 % (n + 1), h2 % (n + 1)) as i, greatest(h1 % (n + 1), h2 % (n + 1)) as j from f),
        p as (select *, array_to_string(u[1:i], '') as pre, array_to_string(u[i + 1:j], '') as mid, array_to_string(u[j + 1:], '') as suf from c)
        select doc_id, n, form, case when form <> 'plain' then length(pre) end as prefix_chars,
               case when form <> 'plain' then length(mid) end as middle_chars,
               sha256(case form when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
                   when 'spm' then '<S>' || suf || '<P>' || pre || '<M>' || mid else x end) as output_sha256,
               sha256(x) as restored_sha256
        from p
        """,
    "op12_phrase_collocations": rf"""
        with p as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) as p from documents),
        w as (select lang, regexp_extract_all(p, '[^\x20\x09]+') as w from p),
        n as (select lang, sum(len(w))::bigint as n from w group by 1),
        g as (select lang, m, unnest(list_transform(generate_series(1, len(w) - m + 1), lambda i: array_to_string(w[i:i + m - 1], ' '))) as phrase
              from w, generate_series(1, 5) as s(m) where len(w) >= m),
        f as (select lang, m, phrase, count(*)::hugeint as f from g group by all having count(*) >= 100),
        c as (select *, string_split(phrase, ' ') as w from f where m > 1),
        k as (select lang, m, phrase, f as a, k, array_to_string(w[1:k], ' ') as x, array_to_string(w[k + 1:], ' ') as y
              from c, generate_series(1, 4) as s(k) where k < m),
        s as (select k.*, l.f as l, r.f as r, n.n, (1000::hugeint * a * n.n) // (l.f * r.f) as score
              from k join f l on l.lang = k.lang and l.phrase = x join f r on r.lang = k.lang and r.phrase = y join n on n.lang = k.lang),
        b as (select * from s qualify row_number() over (partition by lang, phrase order by score, k) = 1),
        o as (select * from b where not exists (select 1 from c where c.lang = b.lang and c.m > b.m and c.f >= b.a
              and contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' '))),
        t as (select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank from o)
        select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n, score::bigint as score from t where rank <= 2000
        """,
    "op13_license_scan": rf"""
        with w as (select row_number() over () as id, doc_id,
              regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
        q(label, phrase) as (values {_values(licenses.BASE_PHRASES)}),
        h as (select id, label, unnest(list_filter(generate_series(1, len(w) - len(string_split(phrase, ' ')) + 1),
              lambda i: w[i:i + len(string_split(phrase, ' ')) - 1] = string_split(phrase, ' '))) - 1 as place from w, q),
        b as (select id, count(*) as n_base, min(place) as first_word, max(place) as last_word,
              string_agg(distinct label, ',' order by label) as base_labels from h group by 1),
        v(label, phrase) as (values {_values(licenses.TEMPLATES)}),
        t as (select phrase, label, list_distinct(string_split(phrase, ' ')) as s,
              greatest(2, 2 ** ceil(log2(len(string_split(phrase, ' ')))))::bigint as half from v),
        k as (select w.id, half, i * half as lo, (i + 2) * half as hi, list_distinct(w[i * half + 1:(i + 2) * half]) as s
              from (select id, w, half, unnest(generate_series(0, (len(w) - 1) // half)) as i from w, (select distinct half from t) where len(w) > 0) w),
        m as (select id, label, phrase, t.s, lo, hi, len(list_intersect(t.s, k.s)) / len(t.s) as c from k join t using (half)
              where 20 * len(list_intersect(t.s, k.s)) >= 19 * len(t.s)),
        o as (select * from m where not exists (select 1 from m as z where z.id = m.id and len(z.s) > len(m.s) and list_has_all(z.s, m.s)
              and z.lo < m.hi and m.lo < z.hi)),
        a as (select id, label, c from o union all select id, label, 1.0 from h),
        l as (select id, string_agg(distinct label, ',' order by label) as labels, max(c) as score from a group by 1)
        select doc_id, len(w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word, last_word,
               coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0.0)::double as score
        from w left join b using (id) left join l using (id)
        """,
}


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that it can express; the others are held against brute force in tests/llm."""
    return dict(ORACLE)
