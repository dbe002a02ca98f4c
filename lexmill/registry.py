"""Queries over the driver's tables, one or more for each operator family, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import scores as S
from lexmill.functions import text as T
from lexmill.operators import anomaly, discovery, governance, graph, matching, rules, similarity
from lexmill.operators.components import connected_components
from lexmill.plans import views as V

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# --- SQL fragments shared by the oracles -----------------------------------------------------------------------------
NORM = "trim(regexp_replace(lower({0}), '\\s+', ' ', 'g'))"
VERSION = "regexp_matches({0}, '(?i)\\b(v\\d+|\\d+\\.\\d+|\\d{{4}}|\\d+\\s*bit|es\\d+|python\\s*\\d+)\\b')"
TAX = """
    select p_type grp, p_name canonical, p_brand alias, p_partkey pos, trim(regexp_replace(lower(p_type), '\\s+', ' ', 'g')) gn,
    trim(regexp_replace(lower(p_name), '\\s+', ' ', 'g')) cn, trim(regexp_replace(lower(p_brand), '\\s+', ' ', 'g')) an from part
"""
CANON = f"""
    tax as ({TAX}), canon as (select distinct grp, canonical, gn, cn from tax where gn <> cn), ali as (select * from tax where alias
    is not null and gn <> cn)
"""
ODD = """
    odd as (select p_partkey, case p_partkey % 7 when 0 then p_brand || '/' || p_name when 1 then p_name || ' (' || p_brand || ')'
    when 2 then p_name || ' and ' || p_type when 3 then 'Advanced  ' || p_name when 4 then p_name || ', ' || p_type when 5 then p_name
    || ' v' || p_size else '  ' || upper(p_name) || '-' || p_brand end as name from part)
"""
NODES = """
    nodes as (select c_name skill, coalesce(n, 0)::bigint total_count, n_name grp, r_name super_grp from customer left join (select
    o_custkey, count(*) n from orders group by 1) on o_custkey = c_custkey join nation on
    c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)
"""
JD = """
    jd as (select distinct l_orderkey doc, p_name item from lineitem join part on l_partkey = p_partkey), edges as (select x.item a,
    y.item b, count(*)::bigint weight from jd x join jd y on x.doc = y.doc and x.item < y.item group by 1, 2)
"""
HEAVY = "heavy as (select * from edges where weight >= (select quantile_disc(weight, 0.9) from edges))"
MENTION = """
    m as (select 'Skill ' || json_extract_string(props, '$.k') as name, lower('skill_' || json_extract_string(props, '$.k')) as key,
    event_type tag, 'u' || user_id source, strftime(ts, '%Y-%m-%d') as day, event_id ord from events)
"""
GRAMS = """
    terms as (select distinct p_name term from part), g as (select distinct term, substr(k, i, 3) gram from (select term,
    replace(trim(lower(term)), ' ', '_') k, unnest(generate_series(1, greatest(length(term) - 2, 1))) i from terms)), sz as (select
    term, count(*) n from g group by 1), sim as (select x.term a, y.term b, count(*) / (sqrt(max(sx.n)) * sqrt(max(sy.n))) score from
    g x join g y on x.gram = y.gram and x.term < y.term join sz sx on sx.term = x.term join sz sy on sy.term = y.term group by 1, 2)
"""


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return keep


# --- scalar functions and predicates ---------------------------------------------------------------------------------
@query(
    f"""
    with {ODD} select p_partkey, {NORM.format('name')} as norm,
    {NORM.format(chr(39).join(['translate(name, ', '-_', ', ', '  ', ')']))} as alias_key,
    trim(regexp_replace(regexp_replace(lower(name), '[^a-z0-9\\s#+.]', '', 'g'), '\\s+', ' ', 'g')) as stripped, trim(lower(name)) as
    weak, replace(lower(name), ' ', '_') as queue_key, md5(name) as hash, case when length(name) <= 20 then name else substr(name, 1,
    17) || '...' end as short from odd
    """
)
def normalize_terms(spark, sf_dir):
    """[FN-01..05, FN-15, FN-17, FN-19]"""
    n = F.col("name")
    return V.odd_names(spark, sf_dir).select("p_partkey", T.normalize(n).alias("norm"), T.equivalence_key(n).alias("alias_key"), T.strip_punctuation(n).alias("stripped"), T.weak_normalize(n).alias("weak"), T.queue_key(n).alias("queue_key"), T.text_hash(n).alias("hash"), T.truncated(n, 20).alias("short"))


@query(
    f"""
    with {ODD}, n as (select p_partkey, name, {NORM.format('name')} as norm from odd) select p_partkey, concat_ws(',', case when
    contains(name, '/') then 'slash' end, case when contains(name, ',') then 'comma' end, case when contains(name, '(') or
    contains(name, ')') then 'parentheses' end, case when regexp_matches(norm, '\\band\\b') then 'and' end, case when
    regexp_matches(norm, '^(core|advanced|basic|modern|enterprise|backend|frontend) ') then 'contextual_prefix' end, case when
    {VERSION.format('norm')} then 'version_like' end) as reasons from n
    """
)
def atomicity_flags(spark, sf_dir):
    """[PD-01..03]"""
    return V.odd_names(spark, sf_dir).select("p_partkey", F.array_join(T.atomicity_reasons(F.col("name")), ",").alias("reasons"))


@query(
    """
    with t as (select distinct p_name term, replace(trim(lower(p_name)), ' ', '_') k from part), x as (select term, k,
    unnest(generate_series(1, greatest(length(k) - 2, 1))) i from t) select distinct term, substr(k, i, 3) as gram from x
    """
)
def char_trigrams(spark, sf_dir):
    """[FN-06, CJ-05]"""
    t = V.table(spark, sf_dir, "part").select(F.col("p_name").alias("term")).distinct()
    return t.select("term", F.explode(T.char_ngrams(T.normalize(F.col("term")))).alias("gram"))


@query(
    f"""
    with {ODD}, x as (select p_partkey, unnest(regexp_split_to_array(replace(replace({NORM.format('name')}, '(', ' '), ')', ' '),
    '[/,+&]|\\band\\b')) as part from odd) select distinct p_partkey, {NORM.format('part')} as token from x where
    {NORM.format('part')} <> ''
    """
)
def explicit_tokens(spark, sf_dir):
    """[FN-08, FN-09]"""
    return V.odd_names(spark, sf_dir).select("p_partkey", F.explode(T.explicit_tokens(F.col("name"))).alias("token"))


@query(
    f"""
    with {ODD} select p_partkey, trim(regexp_replace(name, '\\([^)]+\\)', '', 'g')) as base, trim(regexp_extract(name,
    '\\(([^)]+)\\)', 1)) as alias from odd where contains(name, '(')
    """
)
def paren_rewrite(spark, sf_dir):
    """[FN-07, GV-04]"""
    p = T.parenthetical_split(F.col("name"))
    return V.odd_names(spark, sf_dir).filter(p.isNotNull()).select("p_partkey", p["base"].alias("base"), p["alias"].alias("alias"))


@query(
    f"""
    with {ODD} select p_partkey, case p_partkey % 7 when 0 then 'split_on_slash' when 1 then 'remove_parentheses' when 2 then
    'split_on_and' when 3 then 'needs_exception' when 4 then 'split_on_comma' when 5 then 'needs_exception' else 'keep' end as action,
    case p_partkey % 7 when 0 then 2 when 1 then 1 when 2 then 2 when 3 then 0 when 4 then 2 when 5 then 0 else 1 end as parts from
    odd
    """
)
def rewrite_actions(spark, sf_dir):
    """[GV-04, PD-04]"""
    d = T.rewrite_decision(F.col("name"))
    return V.odd_names(spark, sf_dir).select("p_partkey", d["action"].alias("action"), F.size(d["parts"]).alias("parts"))


@query(
    """
    select p_partkey, lower(array_to_string(list_transform(regexp_extract_all(p_name, '[a-zA-Z0-9]+'), lambda x: substr(x, 1, 1)),
    '')) as acronym, regexp_matches(upper(p_brand), '^[A-Z0-9]{2,12}$') as acronym_like from part
    """
)
def acronyms(spark, sf_dir):
    """[FN-10, FN-11]"""
    return V.table(spark, sf_dir, "part").select("p_partkey", T.acronym(F.col("p_name")).alias("acronym"), T.is_acronym_like(F.upper("p_brand")).alias("acronym_like"))


@query(
    """
    select event_id, case when event_id % 2 = 0 then event_type else event_type || ' x' end as name, case when event_id % 2 = 0 then
    'Group ' || user_id end as tag, strftime(ts, '%Y-%m-%d') as day, case when event_id % 3 = 0 then 'a_b' else 'unknown' end as slug
    from events
    """
)
def tagged_mentions(spark, sf_dir):
    """[FN-14, FN-16, FN-18]"""
    even = F.col("event_id") % 2 == 0
    raw = F.when(even, F.concat("event_type", F.lit(" [Group_"), F.col("user_id").cast("string"), F.lit("]"))).otherwise(F.concat("event_type", F.lit(" x")))
    s = T.skill_and_tag(raw)
    slug = T.status_slug(F.when(F.col("event_id") % 3 == 0, F.lit(" A!! b ")).otherwise(F.lit("--")))
    return V.table(spark, sf_dir, "events").select("event_id", s["name"].alias("name"), s["tag"].alias("tag"), T.date_prefix(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("day"), slug.alias("slug"))


@query(
    """
    select o_orderkey, case when o_totalprice > 300000 then 'HIGH' when o_totalprice > 150000 then 'MEDIUM' else 'LOW' end as
    confidence, case when o_totalprice > 150000 then 'active' else 'under_review' end as status, o_orderstatus = 'F' as flag,
    coalesce(try_cast(substr(o_orderpriority, 1, 1) as bigint), 0) as number from orders
    """
)
def enumerations(spark, sf_dir):
    """[FN-27..29, FN-41]"""
    given = F.when(F.col("o_totalprice") > 300000, "very high").when(F.col("o_totalprice") > 150000, "0.61").otherwise(" Low ")
    conf = S.confidence(given)
    return V.table(spark, sf_dir, "orders").select("o_orderkey", conf.alias("confidence"), S.status(F.lit("?"), conf).alias("status"), S.boolean(F.when(F.col("o_orderstatus") == "F", "Yes").otherwise("maybe")).alias("flag"), S.safe_int(F.substring("o_orderpriority", 1, 1)).alias("number"))


# --- rules -----------------------------------------------------------------------------------------------------------
#: blocking, proposed action and reason of a rule's findings
_FIXED = {
    "l1_002_duplicates": ("true", "merge_duplicates", "canonical occurs more than once"),
    "l1_003_collisions": ("true", "remove_alias", "alias equals a canonical"),
    "l1_004_multiplicity": ("true", "choose_canonical", "alias maps to several canonicals"),
    "l1_005_group": ("true", "rename_canonical", "group name equals a canonical"),
    "l1_009_dup_alias": ("false", "remove_alias", "alias is repeated"),
    "l1_011_auto_drop": ("false", "remove_alias", "alias equals another canonical"),
}


def _rule(name: str, doc: str, build: Callable[[DataFrame], DataFrame], sql: str) -> None:
    def run(spark, sf_dir):
        return build(V.tax(spark, sf_dir)).select(*rules.FINDING)

    run.__name__, run.__doc__ = name, doc
    blocking, action, reason = _FIXED[name]
    query(f"select *, {blocking} as blocking, '{action}' as proposed_action, '{reason}' as reason from ({sql})")(run)


_AT = "'group:' || grp || '.canonical:' || canonical"
_LIST = "array_to_string(list_sort(list(distinct " + _AT + ")){0}, ', ')"
_rule("l1_002_duplicates", "[L1-002, JN-01]", rules.duplicate_canonicals, f"with {CANON} select 'L1-002' as rule_id, {_LIST.format('')} as location, cn as observed_value, cn as normalized_value from canon group by cn having count(*) > 1")
_rule("l1_003_collisions", "[L1-003, JN-03]", lambda t: rules.alias_collisions(_mirrored(t)), f"with tax0 as ({TAX}), tax as (select grp, canonical, alias, pos, gn, cn, an from tax0 union all select grp, alias, canonical, pos, gn, an, cn from tax0), canon as (select distinct grp, canonical, gn, cn from tax where gn <> cn), ali as (select * from tax where alias is not null and gn <> cn), a as (select an norm, {_LIST.format('[1:10]')} as here from ali group by 1), c as (select cn norm, {_LIST.format('[1:10]')} as loc from canon group by 1) select 'L1-003' as rule_id, here || ' | ' || loc as location, norm as observed_value, norm as normalized_value from a join c using (norm)")
_rule("l1_004_multiplicity", "[L1-004, JN-02]", rules.alias_multiplicity, f"with {CANON} select 'L1-004' as rule_id, {_LIST.format('[1:10]')} as location, an as observed_value, an as normalized_value from ali group by an having count(distinct cn) > 1")
_rule("l1_005_group", "[L1-005, JN-04]", lambda t: rules.group_collisions(_grouped(t)), f"with tax0 as ({TAX}), tax as (select grp, canonical, gn, cn from tax0 union all select canonical, alias, cn, an from tax0), canon as (select distinct grp, canonical, gn, cn from tax where gn <> cn), c as (select cn norm, {_LIST.format('')} as loc from canon group by 1), gs as (select distinct grp as name, gn norm from tax) select 'L1-005' as rule_id, loc as location, name as observed_value, norm as normalized_value from gs join c using (norm)")
_rule("l1_009_dup_alias", "[L1-009, WN-01]", rules.repeated_aliases, f"with {CANON}, r as (select *, row_number() over (partition by grp, canonical, an order by pos) nth from ali) select 'L1-009' as rule_id, {_AT} as location, alias as observed_value, an as normalized_value from r where nth > 1")
_rule("l1_011_auto_drop", "[L1-011, JN-06]", lambda t: rules.auto_dropped(_mirrored(t)), f"with tax0 as ({TAX}), tax as (select grp, canonical, alias, gn, cn, an from tax0 union all select grp, alias, canonical, gn, an, cn from tax0), canon as (select distinct cn from tax where gn <> cn), a as (select distinct grp, canonical, alias, an, cn from tax where alias is not null and gn <> cn) select 'L1-011' as rule_id, {_AT} as location, alias as observed_value, an as normalized_value from a where an in (select cn from canon) and an <> cn")


def _mirrored(t: DataFrame) -> DataFrame:
    """All aliases as canonicals too, so that both sides collide."""
    return t.unionByName(t.select("grp", "grp_pos", F.col("alias").alias("canonical"), "canonical_pos", F.col("canonical").alias("alias"), "alias_pos"))


def _grouped(t: DataFrame) -> DataFrame:
    """All canonicals as groups too."""
    return t.unionByName(t.select(F.col("canonical").alias("grp"), "grp_pos", F.col("alias").alias("canonical"), "canonical_pos", F.lit(None).cast("string").alias("alias"), "alias_pos"))


@query(f"with {CANON} select grp, canonical, alias from ali where (cn, an) in (select cn, min(an) from tax group by 1)")
def hard_block_pairs(spark, sf_dir):
    """[PD-05, L1-008, IO-15]"""
    t = V.tax(spark, sf_dir)
    pairs = t.groupBy("canonical").agg(F.min("alias").alias("alias"))  # the least alias of each canonical is blocked
    keyed = pairs.select(T.normalize(F.col("canonical")).alias("c"), T.normalize(F.col("alias")).alias("a"))
    return rules.aliases(t).join(keyed, (T.normalize(F.col("canonical")) == F.col("c")) & (T.normalize(F.col("alias")) == F.col("a")), "left_semi").select("grp", "canonical", "alias")


@query(
    f"""
    with {ODD}, t as (select 'g' || (p_partkey % 5) grp, name, {NORM.format('name')} norm from odd) select 'group:' || grp ||
    '.canonical:' || name as location, norm as normalized_value from (select distinct grp, name, norm from t) where contains(name,
    '/') or contains(name, ',') or contains(name, '(') or regexp_matches(norm, '\\band\\b') or regexp_matches(norm,
    '^(core|advanced|basic|modern|enterprise|backend|frontend) ') or {VERSION.format('norm')}
    """
)
def l1_006_non_atomic(spark, sf_dir):
    """[L1-006, L1-010, PD-06]"""
    return rules.non_atomic(_odd_terms(spark, sf_dir)).select("location", "normalized_value")


@query(
    f"""
    with {ODD}, t as (select distinct 'g' || (p_partkey % 5) grp, name, {NORM.format('name')} norm from odd) select 'group:' || grp ||
    '.canonical:x' as location, name as observed_value from t where {VERSION.format('norm')}
    """
)
def l1_007_versions(spark, sf_dir):
    """[L1-007, PD-02]"""
    t = _odd_terms(spark, sf_dir).select("grp", F.lit("x").alias("canonical"), F.col("canonical").alias("alias")).distinct()
    return rules.versioned_aliases(t).select("location", "observed_value")


def _odd_terms(spark, sf_dir) -> DataFrame:
    o = V.odd_names(spark, sf_dir)
    return o.select(F.concat(F.lit("g"), (F.col("p_partkey") % 5).cast("string")).alias("grp"), F.lit(0).alias("grp_pos"), F.col("name").alias("canonical"), F.lit(0).alias("canonical_pos"), F.lit(None).cast("string").alias("alias"), F.lit(0).alias("alias_pos"))


@query(
    f"""
    with {CANON}, f as (select 'L1-002' as rule_id, true as blocking from canon group by cn having count(*) > 1 union all select
    'L1-004', true from ali group by an having count(distinct cn) > 1 union all select 'L1-009', false from (select row_number() over
    (partition by grp, canonical, an order by pos) nth from ali) where nth > 1) select rule_id, count(*)::bigint as n, count(*) filter
    (blocking)::bigint as errors, count(*) filter (not blocking)::bigint as warnings from f group by rollup (rule_id)
    """
)
def findings_summary(spark, sf_dir):
    """[AG-01, AG-02, SO-02, FN-40]"""
    t = V.tax(spark, sf_dir)
    f = rules.duplicate_canonicals(t).unionByName(rules.alias_multiplicity(t)).unionByName(rules.repeated_aliases(t))
    return rules.findings_summary(f)


@query(
    f"""
    with {CANON}, k as (select canonical w from canon union all select alias from ali), c as (select trim(lower(w)) k, count(*) n from
    k group by 1) select sum(n)::bigint as total, count(*)::bigint as unique_terms, sum(n - 1)::bigint as surplus, count(*) filter (n
    > 1)::bigint as duplicated from c
    """
)
def duplicate_keywords(spark, sf_dir):
    """[AG-06]"""
    t = V.tax(spark, sf_dir)
    k = rules.canonicals(t).select(F.col("canonical").alias("keyword")).unionByName(rules.aliases(t).select(F.col("alias").alias("keyword")))
    return rules.duplicate_report(k, normal=True)


@query(
    f"""
    with {CANON}, s as (select grp, canonical, cn, count(alias) n from tax group by all), r as (select grp, canonical, row_number()
    over (partition by cn order by n desc, lower(grp), lower(canonical)) nth from s), ag as (select an from ali group by 1 having
    count(*) > 1) select r.grp, r.canonical, a.alias from r left join (select grp, canonical, alias from ali where an not in (select
    an from ag)) a using (grp, canonical) where nth = 1
    """
)
def resolve_duplicates(spark, sf_dir):
    """[SO-07, WN-03]"""
    return rules.resolved_duplicates(V.tax(spark, sf_dir))


@query(
    """
    with t as (select distinct p_type grp, p_name canonical, p_name || ' of ' || p_brand as alias from part), h as (select t.grp,
    t.canonical, t.alias, o.canonical matched, row_number() over (partition by t.grp, t.canonical, t.alias order by
    length(o.canonical) desc, o.canonical) nth from t join (select distinct p_type grp, p_brand canonical from part) o on o.grp =
    t.grp and (trim(lower(t.alias)) = lower(o.canonical) or ends_with(trim(lower(t.alias)), ' ' || lower(o.canonical)))) select grp,
    canonical, alias, matched from h where nth = 1
    """
)
def suffix_overlap(spark, sf_dir):
    """[JN-07, WN-05]"""
    p = V.table(spark, sf_dir, "part")
    named = p.select(F.col("p_type").alias("grp"), F.col("p_name").alias("canonical"), F.concat("p_name", F.lit(" of "), "p_brand").alias("alias"))
    brands = p.select(F.col("p_type").alias("grp"), F.col("p_brand").alias("canonical"), F.lit(None).cast("string").alias("alias"))
    return rules.suffix_overlaps(named.unionByName(brands).distinct())


@query(
    """
    with n as (select distinct p_type grp, w from (select p_type, p_name w from part union all select p_type, p_name || ' of ' ||
    p_brand from part union all select p_type, p_brand from part)), k as (select grp, w, trim(lower(w)) norm from n) select x.grp, x.w
    as canonical, y.w as ends_in from k x join k y on x.grp = y.grp and x.norm <> y.norm and ends_with(x.norm, ' ' || y.norm)
    """
)
def redundant_tokens(spark, sf_dir):
    """[JN-22, SM-07]"""
    p = V.table(spark, sf_dir, "part")
    a = p.select(F.col("p_type").alias("grp"), F.col("p_name").alias("canonical"), F.concat("p_name", F.lit(" of "), "p_brand").alias("alias"))
    b = p.select(F.col("p_type").alias("grp"), F.col("p_brand").alias("canonical"), F.lit(None).cast("string").alias("alias"))
    return rules.redundant_tokens(a.unionByName(b).distinct())


@query(
    f"""
    with {CANON}, r as (select cn term, grp, canonical, 'canonical' kind from canon union select an, grp, canonical, 'alias' from ali)
    select term, count(*)::bigint as places, min(grp || '|' || canonical || '|' || kind) as first_place from r group by 1
    """
)
def reverse_index(spark, sf_dir):
    """[CJ-04]"""
    r = rules.reverse_index(V.tax(spark, sf_dir))
    return r.select("term", F.size("places").cast("bigint").alias("places"), F.array_min(F.transform("places", lambda x: F.concat_ws("|", x["grp"], x["canonical"], x["kind"]))).alias("first_place"))


@query(
    """
    with k as (select lower(p_brand) as key, lower(p_name) canonical, p_partkey pos from part union all select lower(p_name),
    lower(p_name), -1 from part) select key, max_by(canonical, pos) as canonical from k group by 1
    """
)
def alias_map(spark, sf_dir):
    """[CJ-03, CJ-01]"""
    return rules.alias_map(V.tax(spark, sf_dir)).select("key", "canonical")


# --- similarity ------------------------------------------------------------------------------------------------------
@query(
    f"""
    with {GRAMS} select a as \"left\", b as \"right\", round(score, 6) as score, case when score > 0.93 then 'high_collision' else
    'possible_conflict' end as band from sim where score >= 0.5
    """
)
def sim_join_part_names(spark, sf_dir):
    """[SM-01, SM-04, JN-08, FN-26, PD-12] the flagship: trigram similarity self-join of term names."""
    return similarity.trigram_edges(V.table(spark, sf_dir, "part").select(F.col("p_name").alias("term")), threshold=0.5)


@query(
    """
    with al as (select distinct p_type grp, p_name source_canonical, p_name || 's' as alias from part), names as (select distinct
    p_name term from part), x as (select distinct alias term from al union select term from names), g as (select distinct term,
    substr(k, i, 3) gram from (select term, replace(lower(term), ' ', '_') k, unnest(generate_series(1, length(term) - 2)) i from x)),
    sz as (select term, count(*) n from g group by 1), sim as (select p.term a, q.term b, count(*) / (sqrt(max(sp.n)) *
    sqrt(max(sq.n))) score from g p join g q using (gram) join sz sp on sp.term = p.term join sz sq on sq.term = q.term where p.term
    in (select alias from al) and q.term in (select term from names) group by 1, 2) select grp, source_canonical, alias, b as
    target_canonical, round(score, 6) as score, case when score > 0.93 then 'high_collision' else 'possible_conflict' end as band from
    al join sim on a = alias where b <> source_canonical and score >= 0.6
    """
)
def alias_advisories(spark, sf_dir):
    """[JN-09, SM-05]"""
    p = V.table(spark, sf_dir, "part").select(F.col("p_type").alias("grp"), F.col("p_name").alias("canonical"), F.concat("p_name", F.lit("s")).alias("alias"))
    return similarity.alias_advisories(p, threshold=0.6)


@query(
    """
    with v as (select vec_id id, label grp, embedding::double[] vec from embeddings), p as (select x.id, x.grp, y.id t, y.grp tg,
    list_dot_product(x.vec, y.vec) / (sqrt(list_dot_product(x.vec, x.vec)) * sqrt(list_dot_product(y.vec, y.vec))) s from v x join v y
    on x.id <> y.id) select id, grp, arg_max(t, s) as best_id, round(max(s), 6) as best_score, arg_max(t, s) filter (grp = tg) as
    best_in_group, round(max(s) filter (grp = tg), 6) as in_group_score from p group by 1, 2
    """
)
def dense_nearest(spark, sf_dir):
    """[JN-11, SM-02, SM-09]"""
    v = V.vectors(spark, sf_dir)
    out = similarity.dense_nearest(v, v)
    return out.select("id", "grp", "best_id", F.round("best_score", 6).alias("best_score"), "best_in_group", F.round("in_group_score", 6).alias("in_group_score"))


@query(
    """
    with n as (select distinct p_name as name from part), b as (select distinct p_brand || ' ' || p_name as name from part), t as
    (select distinct upper(p_type) as name from part), k as (select distinct p_name || '!' as name from part), brands as (select
    lower(p_brand) as key, arg_max(lower(p_name), p_partkey) canonical from part group by 1) select name, name as canonical, 'exact'
    as match_type, 1.0::double as confidence from (select lower(name) as name from n) union all select name, lower(name),
    'group_exact', 1.0 from t union all select name, lower(rtrim(name, '!')), 'normalized', 0.95 from k
    """
)
def match_exact_stripped(spark, sf_dir):
    """[JN-10 tiers 0 to 2, CJ-03]"""
    p = V.table(spark, sf_dir, "part")
    names = p.select(F.lower("p_name").alias("name")).unionByName(p.select(F.upper("p_type").alias("name"))).unionByName(p.select(F.concat("p_name", F.lit("!")).alias("name"))).distinct()
    return matching.match(names, V.tax(spark, sf_dir), fuzzy=False).select("name", "canonical", "match_type", "confidence")


@query(
    """
    with n as (select distinct p_name as n from part)
    select n || right(n, 1) as name, n as canonical, 'fuzzy' as match_type, round(2.0 * length(n) / (2 * length(n) + 1), 3)::double as confidence from n
    union all select 'the best ' || n || ' that money can buy in any shop', n, 'containment', 0.8 from n
    """
)
def match_fuzzy(spark, sf_dir):
    """[SM-06, SM-08, JN-10 tiers 3 and 4] names with a doubled last letter, and names inside longer ones."""
    p = V.table(spark, sf_dir, "part")
    names = p.select(F.concat("p_name", F.substring("p_name", -1, 1)).alias("name")).unionByName(p.select(F.concat(F.lit("the best "), "p_name", F.lit(" that money can buy in any shop")).alias("name"))).distinct()
    return matching.match(names, V.tax(spark, sf_dir))


# --- anomaly ---------------------------------------------------------------------------------------------------------
@query(
    f"""
    with {NODES}, l as (select skill, total_count, ln(total_count) x from nodes where total_count > 0), f as (select avg(x) m,
    stddev_samp(x) s from l) select skill, total_count, round(x, 4) as log_count, round((x - m) / s, 4) as z, abs((x - m) / s) >= 2 as
    flagged from l, f
    """
)
def log_outliers(spark, sf_dir):
    """[AN-01, AG-07, FN-20, FN-22, PD-07, PD-08]"""
    return anomaly.log_outliers(V.skill_nodes(spark, sf_dir))


def _group_sql(center: str, spread: str) -> str:
    return f"with {NODES}, l as (select *, ln(total_count) x from nodes where total_count > 0), g as (select {center} gc, {spread} gs from l), k as (select grp, count(*)::bigint as size, {center} c, {spread} s from l group by 1), r as (select l.*, size, (x - gc) / nullif(gs, 0) g, case when size >= 5 and round(s, 4) > 0 then (x - round(c, 4)) / round(s, 4) end as z from l join k using (grp), g) select skill, total_count, round(x, 4) as log_count, grp, super_grp, size, case when round(g, 4) = 0 then 0.0 else round(g, 4) end as global_z, case when round(z, 4) = 0 then 0.0 else round(z, 4) end as group_z, round(coalesce(0.4 * abs(g) + 0.6 * abs(z), abs(g)), 4) as suspicion_score, case when z is null then case when abs(g) >= 2 then 'suspect_global_only' else 'normal' end when abs(g) >= 2 and abs(z) >= 2 then 'likely_false_positive' when abs(g) >= 2 then 'legitimate_hub' when abs(z) >= 2 then 'group_anomaly' else 'normal' end as verdict from r where g is not null"


@query(_group_sql("median(x)", "mad(x) * 1.4826"))
def group_outliers_mad(spark, sf_dir):
    """[AN-02, AG-08, AG-09, FN-22..24, WN-06]"""
    return anomaly.group_outliers(V.skill_nodes(spark, sf_dir))


@query(_group_sql("avg(x)", "stddev_samp(x)"))
def group_outliers_std(spark, sf_dir):
    """[AN-02, AG-09]"""
    return anomaly.group_outliers(V.skill_nodes(spark, sf_dir), robust=False)


@query(
    f"""
    with {NODES}, l as (select *, ln(total_count + 1) x from nodes), f as (select avg(x) m, stddev_samp(x) s from l), g as (select
    grp, avg(x) gm, case when count(*) = 1 then 0.1 else stddev_samp(x) end gs from l group by 1) select skill, grp, total_count,
    round(x, 4) as log_count, round((x - m) / nullif(s, 0), 4) as global_z, round((x - gm) / nullif(gs, 0), 4) as group_z from l join
    g using (grp), f
    """
)
def anomaly_ln1p(spark, sf_dir):
    """[AN-03, AG-10, FN-21]"""
    return anomaly.anomaly_ln1p(V.skill_nodes(spark, sf_dir))


@query(
    f"""
    with {NODES}, l as (select skill, total_count, ln(total_count) x from nodes where total_count >= 3), f as (select avg(x) m,
    stddev_samp(x) s from l), z as (select skill, total_count, (x - m) / nullif(s, 0) z from l, f) select skill, total_count, round(z,
    4) as z, case when round(z, 4) >= 3 then 'false_positive' when round(z, 4) >= 2 then 'investigate' else 'legitimate' end as class
    from z
    """
)
def refit_at_least(spark, sf_dir):
    """[AN-04, WN-07, PD-10, PD-15]"""
    return anomaly.refit(V.skill_nodes(spark, sf_dir), 3).select("skill", "total_count", "z", "class")


@query(
    f"""
    with {NODES} select floor(ln(total_count) / 0.2)::bigint as bin, count(*)::bigint as n from nodes where total_count > 0 and
    ln(total_count) <= 9 group by 1
    """
)
def log_histogram(spark, sf_dir):
    """[AG-22, AN-06]"""
    return anomaly.log_histogram(V.skill_nodes(spark, sf_dir))


@query(
    f"""
    with {NODES}, f as (select avg(ln(total_count)) m, stddev_samp(ln(total_count)) s from nodes where total_count > 0) select i::int
    as i, round(exp(-0.5 * pow((i * 0.05 - m) / s, 2)) / (s * sqrt(2 * pi())), 6) as density from f, generate_series(0, 180) t(i)
    """
)
def fitted_curve(spark, sf_dir):
    """[AN-06, FN-25]"""
    return anomaly.fitted_curve(V.skill_nodes(spark, sf_dir))


@query(
    f"""
    with {NODES} select skill, total_count, grp, super_grp from nodes where total_count > 0 and ln(total_count) >= 0.6 and
    ln(total_count) < 1.2
    """
)
def histogram_bin_members(spark, sf_dir):
    """[AN-07]"""
    return anomaly.bin_members(V.skill_nodes(spark, sf_dir), 0.6, 1.2)


@query(f"with {NODES} select super_grp, count(distinct grp)::bigint as sub_groups from nodes group by 1")
def subgroups(spark, sf_dir):
    """[AG-21]"""
    return anomaly.subgroups(V.skill_nodes(spark, sf_dir))


@query(
    f"""
    with {NODES}, {JD}, c as (select avg(case when total_count > 0 then 1.0 else 0.0 end)::double coverage from nodes), n as (select
    100 * avg(case when weight <= 1 then 1.0 else 0.0 end)::double noise from edges) select round(coverage, 4) as coverage,
    round(noise, 4) as noise, case when coverage >= 0.7 then 'good' when coverage >= 0.5 then 'warning' else 'critical' end as
    coverage_health, case when noise <= 30 then 'good' when noise <= 40 then 'warning' else 'critical' end as noise_health from c, n
    """
)
def health_summary(spark, sf_dir):
    """[AN-08, FN-42, AG-20]"""
    return anomaly.health_summary(V.skill_nodes(spark, sf_dir), graph.cooccurrence(V.jd_skill(spark, sf_dir)))


@query(f"with {NODES}, g as (select count(*) n from nodes where total_count > 0 group by grp) select (select count(*) from nodes)::bigint as total, (select count(*) from nodes where total_count > 0)::bigint as connected, (select count(*) from nodes where total_count <= 0)::bigint as disconnected, count(*) filter (n >= 5)::bigint as groups_sufficient, count(*) filter (n < 5)::bigint as groups_fallback, (select count(*) filter (suspicion_score >= 2) from (" + _group_sql("median(x)", "mad(x) * 1.4826") + "))::bigint as flagged from g")
def outlier_summary(spark, sf_dir):
    """[AG-11, AG-23]"""
    n = V.skill_nodes(spark, sf_dir)
    return anomaly.outlier_summary(anomaly.group_outliers(n), n)


# --- graph -----------------------------------------------------------------------------------------------------------
@query(f"with {JD} select * from edges")
def cooccurrence_edges(spark, sf_dir):
    """[GR-10]"""
    return graph.cooccurrence(V.jd_skill(spark, sf_dir))


@query(
    f"""
    with {JD}, d as (select node, count(*) degree, sum(weight) weight_sum, max(weight) weight_max from (select a node, weight from
    edges union all select b, weight from edges) group by 1) select node, degree::bigint as degree, weight_sum::bigint as weight_sum,
    weight_max::bigint as weight_max from d
    """
)
def node_degree(spark, sf_dir):
    """[AG-13, GR-01]"""
    return graph.degrees(graph.cooccurrence(V.jd_skill(spark, sf_dir)))


@query(
    f"""
    with {JD}, d as (select node, count(*)::bigint as degree, sum(weight)::bigint as weight_sum, max(weight)::bigint as weight_max
    from (select a node, weight from edges union all select b, weight from edges) group by 1) select * from d order by degree desc,
    weight_sum desc, node limit 20
    """
)
def top_hubs(spark, sf_dir):
    """[ST-08]"""
    return graph.top_hubs(graph.cooccurrence(V.jd_skill(spark, sf_dir)))


@query(
    f"""
    with {JD} select case when weight = 1 then '1' when weight <= 4 then '2-4' when weight <= 9 then '5-9' when weight <= 19 then
    '10-19' when weight <= 49 then '20-49' when weight <= 99 then '50-99' else '100+' end as bucket, count(*)::bigint as n,
    round(100.0::double * count(*) / (select count(*) from edges), 4) as pct from edges group by 1
    """
)
def edge_weight_distribution(spark, sf_dir):
    """[AG-19]"""
    return graph.weight_distribution(graph.cooccurrence(V.jd_skill(spark, sf_dir)))


@query(
    f"""
    with {JD}, t as (select unnest([1, 2, 5, 10, 20, 50, 100])::int as min_weight), e as (select min_weight, count(*) n from t, edges
    where weight >= min_weight group by 1), top as (select node, max(weight) w from (select a node, weight from edges union all select
    b, weight from edges) group by 1), v as (select min_weight, count(*) n from t, top where w >= min_weight group by 1) select
    e.min_weight, e.n::bigint as edges, round(100.0::double * e.n / (select count(*) from edges), 4) as edges_pct, v.n::bigint as
    nodes, round(100.0::double * v.n / (select count(*) from top), 4) as nodes_pct from e join v using (min_weight)
    """
)
def edge_thresholds(spark, sf_dir):
    """[AG-19, AG-20]"""
    return graph.threshold_breakdown(graph.cooccurrence(V.jd_skill(spark, sf_dir)))


def _sim_edges(spark, sf_dir) -> DataFrame:
    e = similarity.trigram_edges(V.table(spark, sf_dir, "part").select(F.col("p_name").alias("term")), threshold=0.5)
    return e.select(F.col("left").alias("a"), F.col("right").alias("b"), F.col("score").alias("weight"))


@query(
    f"""
    with recursive {GRAMS}, e as (select a, b from sim where score >= 0.5 union select b, a from sim where score >= 0.5), reach as
    (select a, a as r from e union select reach.a, e.b from reach join e on e.a = reach.r), c as (select a node, min(r) component from
    reach group by 1), ids as (select component, 'cluster-' || lpad(cast(row_number() over (order by component) as varchar), 4, '0')
    id from (select distinct component from c)) select node, id from c join ids using (component)
    """
)
def components(spark, sf_dir):
    """[GR-02, WN-04, GR-06]"""
    return graph.numbered(connected_components(_sim_edges(spark, sf_dir)), "cluster")


@query()
def cluster_split(spark, sf_dir):
    """[GR-03..05, AG-14, ST-09] the greedy split of real similarity edges; ``cluster_stars`` has SQL."""
    return graph.clusters(_sim_edges(spark, sf_dir), most=10)


@query(
    """
    with c as (select n_name, c_name, c_acctbal, c_custkey, count(*) over (partition by n_name) n, min(c_name) over (partition by n_name) low, row_number() over (partition by n_name order by c_acctbal desc, c_name) nth from customer join nation on c_nationkey = n_nationkey),
    k as (select *, case when n <= 9 or nth <= 9 then 1 else 0 end as inside from c)
    select least(low, n_name) as component, 0 as split, c_name as term from k where inside = 1
    union all select distinct least(low, n_name), 0, n_name from k
    """
)
def cluster_stars(spark, sf_dir):
    """[GR-03..05, AG-14] customers linked to their nation by their balance: the nation seeds the split and takes its heaviest."""
    c, n = V.table(spark, sf_dir, "customer"), V.table(spark, sf_dir, "nation")
    edges = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("a"), F.col("c_name").alias("b"), F.col("c_acctbal").alias("weight"))
    return graph.clusters(edges, most=10)


@query(
    f"""
    with {GRAMS}, e as (select a, b from sim where score >= 0.5), d as (select node, count(*)::bigint as degree from (select a node, b
    o from e union select b, a from e) group by 1), n as (select count(*) n from d) select node, degree, degree / (n - 1) as ratio
    from d, n where degree / (n - 1) > 0.05
    """
)
def over_generic(spark, sf_dir):
    """[L5-001, PD-13, GR-07]"""
    return graph.over_generic(_sim_edges(spark, sf_dir), 0.05)


@query(
    f"""
    with {GRAMS}, e as (select a, b, round(score, 6) w from sim where score >= 0.5), d as (select node, count(*) degree, sum(w)
    weight_sum, max(w) m from (select a node, b o, w from e union select b, a, w from e) group by 1) select node, weight_sum, m /
    weight_sum as ratio from d where degree = 1 and m / weight_sum >= 0.9
    """
)
def phantom_nodes(spark, sf_dir):
    """[L5-002, PD-14]"""
    return graph.phantoms(_sim_edges(spark, sf_dir))


@query(
    """
    with r as (select p_brand as cluster, p_name || '#' || p_partkey as term, p_type as level from part), c as (select cluster, level,
    count(*) n, min(term) f from r group by 1, 2), m as (select cluster, level as majority from (select *, row_number() over
    (partition by cluster order by n desc, f, level) nth from c) where nth = 1) select cluster, term, level, majority from r join m
    using (cluster) where level <> majority
    """
)
def cluster_disagreement(spark, sf_dir):
    """[L5-003, JN-19, AG-12]"""
    p = V.table(spark, sf_dir, "part").select("p_brand", F.concat("p_name", F.lit("#"), F.col("p_partkey").cast("string")).alias("term"), "p_type")
    return graph.disagreements(p.select(F.col("p_brand").alias("cluster"), "term"), p.select("term", F.col("p_type").alias("level")))


@query(
    """
    with c as (select user_id, event_type, count(*)::bigint as n, min(event_id) f from events group by 1, 2) select user_id,
    event_type as majority, n from (select *, row_number() over (partition by user_id order by n desc, f, event_type) nth from c)
    where nth = 1
    """
)
def majority_value(spark, sf_dir):
    """[AG-12]"""
    return graph.majority(V.table(spark, sf_dir, "events"), "user_id", "event_type", "event_id")


# --- discovery -------------------------------------------------------------------------------------------------------
_QUEUE = """
    select key, arg_min(name, ord) as display_name, count(*)::bigint as seen_count, min(day) as first_seen, max(day) as last_seen,
    case when count(*) >= 100 then 'ready_for_promotion' else 'pending' end as status from m group by 1
"""
_TAGS = """
    t as (select key, array_to_string(list_sort(list(tag || ':' || n)), ',') as tags from (select key, tag, count(*) n from m group by
    1, 2) group by 1), s as (select key, array_to_string(list(source order by o), ',') as sources from (select *, row_number() over
    (partition by key order by o) nth from (select key, source, min(ord) o from m group by 1, 2)) where nth <= 10 group by 1)
"""


def _flat(q: DataFrame) -> DataFrame:
    tags = F.array_join(F.array_sort(F.transform("tags", lambda t: F.concat_ws(":", t["tag"], t["n"].cast("string")))), ",")
    return q.select("key", "display_name", "seen_count", "first_seen", "last_seen", tags.alias("tags"), F.array_join("sources", ",").alias("sources"), "status")


@query(
    f"""
    with {MENTION}, q as ({_QUEUE}), {_TAGS} select key, display_name, seen_count, first_seen, last_seen, tags, sources, status from q
    join t using (key) join s using (key)
    """
)
def discovery_queue(spark, sf_dir):
    """[AG-03, SS-02, FN-15]"""
    return _flat(discovery.new_queue(discovery.queue_delta(V.mentions(spark, sf_dir)), threshold=100))


@query(
    f"""
    with {MENTION}, q as ({_QUEUE}), {_TAGS} select key, display_name, seen_count, first_seen, last_seen, tags, sources, status from q
    join t using (key) join s using (key)
    """
)
def queue_incremental(spark, sf_dir):
    """[SS-01] two batches, the first half of the events and the rest, merged into the queue."""
    m = V.mentions(spark, sf_dir)
    half = m.agg(F.max("ord")).first()[0] // 2
    first = discovery.new_queue(discovery.queue_delta(m.filter(F.col("ord") <= half)), threshold=100)
    return _flat(discovery.merge_queue(first, discovery.queue_delta(m.filter(F.col("ord") > half)), threshold=100))


@query(f"with {MENTION}, q as ({_QUEUE}) select status, count(*)::bigint as n from q group by 1")
def queue_status_counts(spark, sf_dir):
    """[AG-04, PD-09]"""
    return discovery.status_counts(discovery.new_queue(discovery.queue_delta(V.mentions(spark, sf_dir)), threshold=100))


@query(
    f"""
    with {MENTION},
    f as (select skill, list(file order by file) files from (select distinct lower(name) skill, source file from m) group by 1),
    g as (select skill, list(tag order by nth) titles from (select skill, tag, row_number() over (partition by skill order by k, tag) nth
          from (select lower(name) skill, tag, min((source, ord)) k from m group by 1, 2)) where nth <= 3 group by 1)
    select lower(name) as skill, count(*)::bigint as occurrence_count, arg_min(name, (source, ord)) as display_name,
           count(distinct source)::int as n_files, array_to_string(any_value(files), ',') as files, array_to_string(any_value(titles), ',') as titles
    from m join f on f.skill = lower(name) join g on g.skill = lower(name) group by 1
    """
)
def audit_occurrences(spark, sf_dir):
    """[AG-05, ST-07]"""
    out = discovery.audit(_occurrences(spark, sf_dir))
    out = out.withColumn("files", F.array_join("files", ",")).withColumn("titles", F.array_join("titles", ","))
    return out.drop("canonical", "match_type", "confidence")  # none without terms


def _occurrences(spark, sf_dir) -> DataFrame:
    return V.mentions(spark, sf_dir).select("name", F.col("source").alias("file"), F.col("ord").alias("line_number"), F.lit(0).alias("pos"), F.col("tag").alias("title"))


@query(
    f"""
    with {MENTION} select lower(name) as skill, row_number() over (partition by lower(name) order by source, ord)::int as nth, name,
    source as file, ord as line_number, 0 as pos, tag as title from m
    """
)
def audit_rows(spark, sf_dir):
    """[AG-05]"""
    return discovery.occurrence_rows(_occurrences(spark, sf_dir))


@query(
    f"""
    with {MENTION}, q as ({_QUEUE}), tg as (select key, tag, count(*) n from m group by 1, 2), b as (select key, tag from (select *,
    row_number() over (partition by key order by n desc, tag) nth from tg) where nth = 1) select key, display_name, seen_count, b.tag
    as suggested_group, case when key in (select 'skill_' || p_size from part) then 'alias_of:SKILL ' || substr(key, 7) else 'approve'
    end as action from q join b using (key) where status = 'ready_for_promotion'
    """
)
def review_actions(spark, sf_dir):
    """[GV-10, JN-14, AG-15]"""
    m = V.mentions(spark, sf_dir)
    q = discovery.new_queue(discovery.queue_delta(m), threshold=100)
    size = F.col("p_size").cast("string")
    known = V.table(spark, sf_dir, "part").select(F.concat(F.lit("skill "), size).alias("key"), F.concat(F.lit("SKILL "), size).alias("canonical")).distinct()
    groups = V.table(spark, sf_dir, "part").select(F.col("p_type").alias("name")).distinct()
    return discovery.review(q, known, groups).select("key", "display_name", "seen_count", "suggested_group", "action")


@query(
    f"""
    with {MENTION}, q as ({_QUEUE}), r as (select case when key in (select 'skill_' || p_size from part) then 'aliased' else
    'approved' end as a from q where status = 'ready_for_promotion') select count(*) filter (a = 'approved')::bigint as approved,
    count(*) filter (a = 'aliased')::bigint as aliased, 0::bigint as rejected, 0::bigint as skipped from r
    """
)
def apply_review_counts(spark, sf_dir):
    """[GV-11, AG-17]"""
    return discovery.applied(review_actions(spark, sf_dir).withColumn("sources", F.array()))[2]


# --- governance and merging ------------------------------------------------------------------------------------------
_HAS = lambda words: "(" + " or ".join(f"contains(n, '{w}')" for w in words) + ")"
_CLASS = lambda k: " ".join(f"when {_HAS(c[0])} then '{c[k]}'" for c in governance.HEURISTIC_CLASSES)


@query(
    f"""
    with t as (select distinct p_name || case p_partkey % 4 when 0 then ' network' when 1 then ' http' when 2 then ' design' else ''
    end as term from part), x as (select term, trim(lower(term)) n from t) select term, case {_CLASS(1)} else 'Software Artifact' end
    as ontological_nature, case {_CLASS(3)} end as primary_type, case {_CLASS(2)} else 'Concrete' end as abstraction_level, false as
    is_contextual, {VERSION.format('n')} as is_versioned, false as is_marketing_language, 'HIGH' as confidence, 'active' as status
    from x
    """
)
def heuristic_classify(spark, sf_dir):
    """[UD-04, IO-13]"""
    k = F.col("p_partkey") % 4
    end = F.when(k == 0, " network").when(k == 1, " http").when(k == 2, " design").otherwise("")
    t = V.table(spark, sf_dir, "part").select(F.concat("p_name", end).alias("term")).distinct()
    return governance.heuristic_classes(t)


@query(
    f"""
    with {ODD} select cast(p_partkey % 9 as varchar) as cluster_id, name as term, case p_partkey % 7 when 0 then
    'SPLIT_INTO_MULTIPLE_CANONICALS' when 3 then 'MARK_AS_CONTEXTUAL' else 'KEEP_DISTINCT' end as action, case when p_partkey % 7 = 3
    then ' ' || substr(name, 11) end as target_canonical, case when p_partkey % 7 = 3 then 'MEDIUM' else 'HIGH' end as confidence from
    odd
    """
)
def heuristic_arbitrate(spark, sf_dir):
    """[UD-03, FN-08]"""
    return governance.heuristic_arbitration(_members(spark, sf_dir)).select("cluster_id", "term", "action", "target_canonical", "confidence")


def _members(spark, sf_dir) -> DataFrame:
    return V.odd_names(spark, sf_dir).select((F.col("p_partkey") % 9).cast("string").alias("cluster_id"), F.col("name").alias("term"))


@query(
    f"""
    with {ODD} select cast(p_partkey % 9 as varchar) as cluster_id, name as term, 'KEEP_DISTINCT' as effective_action, case when
    p_partkey % 7 = 0 then 'split_target_already_exists_requires_explicit_mapping' else '' end as violations from odd where p_partkey
    % 7 <> 3 union all select cast(p_partkey % 9 as varchar), name, 'MARK_AS_CONTEXTUAL', '' from odd where p_partkey % 7 = 3
    """
)
def governed_decisions(spark, sf_dir):
    """[GV-01, GV-02, GV-03, L3-002]"""
    m = _members(spark, sf_dir).distinct()
    canon = V.table(spark, sf_dir, "part").select(F.col("p_name").alias("canonical")).distinct()
    d = governance.governed(governance.heuristic_arbitration(_members(spark, sf_dir)), m, canon)
    return d.select("cluster_id", "term", "effective_action", F.array_join("violations", ",").alias("violations"))


@query(
    """
    with k as (select distinct lower(p_name) as k from part),
    o as (select p_partkey pos, p_type grp, p_brand || ' ' || p_name as canonical, lower(p_brand || ' ' || p_name) as c, p_name as a1, 'only ' || p_partkey as a2 from part),
    r as (select *, row_number() over (partition by c order by grp, canonical, pos) nth from o)
    select grp, canonical, null as alias, nth = 1 as kept, case when nth > 1 then 'canonical collides with existing term' end as reason from r
    union all select grp, canonical, a1, false, 'alias collides with existing term' from r where nth = 1
    union all select grp, canonical, a2, true, null from r where nth = 1
    """
)
def candidate_merge(spark, sf_dir):
    """[JN-12] candidates by group and name; one alias each that the store has and one that is new."""
    return _merged(spark, sf_dir, False)


@query(
    """
    with o as (select p_partkey pos, p_type grp, p_brand || ' ' || p_name as canonical, lower(p_brand || ' ' || p_name) as c, p_name as a1, 'only ' || p_partkey as a2 from part),
    r as (select *, row_number() over (partition by c order by pos) nth from o)
    select grp, canonical, null as alias, nth = 1 as kept, case when nth > 1 then 'canonical collides with existing term' end as reason from r
    union all select grp, canonical, a1, false, 'alias collides with existing term' from r where nth = 1
    union all select grp, canonical, a2, true, null from r where nth = 1
    """
)
def candidate_merge_by_input(spark, sf_dir):
    """[JN-13]"""
    return _merged(spark, sf_dir, True)


def _merged(spark, sf_dir, by_input: bool) -> DataFrame:
    p = V.table(spark, sf_dir, "part")
    existing = p.select(F.col("p_name").alias("canonical"), F.lit(None).cast("string").alias("alias"))
    aliases = F.array("p_name", F.concat(F.lit("only "), F.col("p_partkey").cast("string")))
    offered = p.select(F.col("p_type").alias("grp"), F.concat("p_brand", F.lit(" "), "p_name").alias("canonical"), aliases.alias("aliases"), F.col("p_partkey").alias("pos"))
    return matching.merged_candidates(existing, offered, by_input)


@query(f"with {ODD}, t as (select distinct 'g' || (p_partkey % 5) grp, name from odd) select grp, count(*)::bigint as n from t group by 1")
def store_round_trip(spark, sf_dir):
    """[CJ-01, CJ-02, IO-01] rows nested to a store, written as JSON text, and flattened again."""
    from lexmill.sources.stores import flatten_store, nest_store

    nested = nest_store(_odd_terms(spark, sf_dir).distinct())
    doc = nested.select(F.to_json(F.map_from_arrays(F.array("grp"), F.array("entries"))).alias("value"))
    return flatten_store(doc).groupBy("grp").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""
    with {ODD}, x as (select p_partkey, p_partkey % 7 k, name, p_brand b, p_name n, p_type t, p_size s from odd join part using (p_partkey)),
    y as (select p_partkey, n, case k when 0 then [b, n] when 1 then [n || ' (' || b || ')'] when 2 then [n, t] when 3 then ['Advanced ' || n] when 4 then [n, t] when 5 then [n || ' v' || s] else [upper(n) || ' ' || b] end as a from x)
    select p_partkey, array_to_string(list_transform(list_sort(list_transform(list_filter(a, lambda v: lower(v) <> string_split(lower(n), ' ')[1]), lambda v: {{'k': lower(v), 'v': v}})), lambda e: e.v), '|') as aliases from y
    """
)
def rewritten_aliases(spark, sf_dir):
    """[FN-12, FN-13, CJ-08, CJ-09, GV-05..07]"""
    from lexmill.functions.udfs import clean_aliases_udf

    o = V.odd_names(spark, sf_dir)
    return o.select("p_partkey", F.array_join(clean_aliases_udf(F.array("name"), F.col("first_word")), "|").alias("aliases"))


def queries() -> dict[str, Query]:
    from lexmill import registry_more  # registers its own

    assert registry_more
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(ORACLE)
