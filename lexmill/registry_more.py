"""More queries over the driver's tables: records, files, stores, replies, sources, and checks of a rewritten store."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions import scores as S
from lexmill.functions import text as T
from lexmill.functions import udfs
from lexmill.operators import anomaly, discovery, governance, graph, replies, rules, similarity
from lexmill.operators.components import shared_folder
from lexmill.plans import views as V
from lexmill.registry import _QUEUE, CANON, GRAMS, JD, MENTION, NODES, NORM, ODD, ORACLE, TAX, VERSION, _group_sql, _members, _mirrored, _odd_terms, _sim_edges, query
from lexmill.sources import providers, pycode, stores


def _file(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


# --- records ---------------------------------------------------------------------------------------------------------
_ITEMS = """
    items as (select o_orderkey as o, o_orderstatus as st, strftime(o_orderdate, '%Y-%m-%d') as day, p_name as name, p_brand as tag, l_linenumber as ln, l_partkey as pk
              from orders join lineitem on l_orderkey = o_orderkey join part on l_partkey = p_partkey)
"""


def _records(spark, sf_dir) -> DataFrame:
    """Orders as record lines, written and read back: the items' names, and again with the brand as tag; a broken line for each nation."""
    o = V.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    li = V.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    p = V.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    items = li.join(p, F.col("l_partkey") == F.col("p_partkey")).groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "p_name", "p_brand"))).alias("i"))  # of one order
    rows = o.join(items, F.col("o_orderkey") == F.col("l_orderkey"))
    line = F.to_json(
        F.struct(
            F.lit("Order").alias("title"),
            F.concat(F.lit("order/"), F.col("o_orderkey").cast("string")).alias("source_url"),
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("scraped_at"),
            (F.col("o_orderstatus") == "P").alias("is_error"),
            F.transform("i", lambda x: F.concat(x["p_name"], F.lit(" ["), x["p_brand"], F.lit("]"))).alias("technical_skills"),
            F.struct(F.transform("i", lambda x: F.initcap(x["p_name"])).alias("unmapped_skills")).alias("extraction_quality"),
        )
    )
    broken = V.table(spark, sf_dir, "nation").select(F.concat(F.lit('{"title": "'), "n_name").alias("value"))
    path = _file(spark, "records")
    rows.select(line.alias("value")).unionByName(broken).write.text(path + "/lines.jsonl")
    return stores.read_records(spark, path + "/lines.jsonl")


@query(
    f"""
    with {_ITEMS}, n as (select *, row_number() over (partition by o, name order by ln, pk) nth from items where st <> 'P')
    select 'order/' || o as source, day, array_to_string(list_transform(string_split(name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') as name, tag
    from n where nth = 1
    """
)
def record_candidates(spark, sf_dir):
    """[IO-03, IO-04, IO-05, IO-07, WN-02, JN-20, FN-14, FN-16]"""
    return discovery.candidates(_records(spark, sf_dir)).select("source", "day", "name", "tag")


@query(
    f"""
    with {_ITEMS}, r as (select distinct o, st from items)
    select count(*) filter (st <> 'P')::bigint as records, (select count(*) from nation)::bigint as parse_errors, count(*) filter (st = 'P')::bigint as skipped from r
    """
)
def record_counts(spark, sf_dir):
    """[AG-18, IO-04]"""
    return stores.record_counts(_records(spark, sf_dir))


@query(
    f"""
    with {MENTION}, q as ({_QUEUE}) select case status when 'pending' then 'pending' else 'ready_for_promotion' end as slug, key,
    display_name, seen_count from q
    """
)
def queue_by_status(spark, sf_dir):
    """[IO-08, CJ-06, FN-18] written as one folder for each status and read back."""
    path = _file(spark, "queue")
    queue = discovery.new_queue(discovery.queue_delta(V.mentions(spark, sf_dir)), threshold=100)
    stores.write_by_status(queue, path)
    kind = "key string, display_name string, seen_count bigint, slug string"
    return spark.read.schema(kind).json(path).select("slug", "key", "display_name", "seen_count")


AUDITED = """
    o as (select case l_linenumber % 3 when 0 then p_name when 1 then p_name || '!' else 'qqqqqqqqqq ' || l_suppkey end as name,
        'f' || (l_orderkey % 97) || '.jsonl' as file, l_orderkey as line, l_linenumber as pos, p_brand as title
        from lineitem join part on l_partkey = p_partkey),
    c as (select lower(name) as skill, count(*)::bigint as n, arg_min(name, (file, line, pos)) as display_name from o group by 1),
    f as (select skill, list(file order by file) as files from (select distinct lower(name) as skill, file from o) group by 1),
    t as (select skill, list(title order by nth) as titles from (select skill, title, row_number() over (partition by skill order by k, title) as nth
        from (select lower(name) as skill, title, min((file, line, pos)) as k from o group by 1, 2)) where nth <= 3 group by 1),
    m as (select skill, case when right(skill, 1) = '!' then 'normalized' when skill not like 'qqq%' then 'exact' end as match_type from c)
"""


def _audited(spark, sf_dir) -> DataFrame:
    """Names as the store has them, with a mark behind, and of no term, by order line."""
    li = V.table(spark, sf_dir, "lineitem").join(V.table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    kind = F.col("l_linenumber") % 3
    name = F.when(kind == 0, F.col("p_name")).when(kind == 1, F.concat("p_name", F.lit("!"))).otherwise(F.concat(F.lit("qqqqqqqqqq "), F.col("l_suppkey").cast("string")))
    file = F.concat(F.lit("f"), (F.col("l_orderkey") % 97).cast("string"), F.lit(".jsonl"))
    rows = li.select(name.alias("name"), file.alias("file"), F.col("l_orderkey").alias("line_number"), F.col("l_linenumber").alias("pos"), F.col("p_brand").alias("title"))
    return discovery.audit(rows, V.tax(spark, sf_dir))


@query(
    f"""
    with {AUDITED} select skill, n as occurrence_count, display_name, case when match_type is not null then rtrim(skill, '!') end as canonical, match_type,
    case match_type when 'exact' then 1.0 when 'normalized' then 0.95 end::double as confidence, len(files)::int as n_files,
    array_to_string(titles, ',') as titles, array_to_string(files, ',') as files
    from c join f using (skill) join t using (skill) join m using (skill)
    """
)
def audit_report(spark, sf_dir):
    """[AG-05, ST-07] the matched audit: all files, the first titles, and the match of each name."""
    return _audited(spark, sf_dir).withColumn("files", F.array_join("files", ",")).withColumn("titles", F.array_join("titles", ","))


@query(
    f"""
    with {AUDITED} select display_name as skill_name, n as total_count, case when match_type is not null then rtrim(skill, '!') end as taxonomy_match,
    match_type, case match_type when 'exact' then '1.0' when 'normalized' then '0.95' end as confidence, array_to_string(titles, ' | ') as top_job_titles,
    array_to_string(files, ' | ') as jsonl_files from c join f using (skill) join t using (skill) join m using (skill)
    """
)
def csv_summary(spark, sf_dir):
    """[IO-09] written as CSV and read back; an empty field is null."""
    path = _file(spark, "summary")
    stores.write_csv_summary(_audited(spark, sf_dir), path)
    kind = "skill_name string, total_count bigint, taxonomy_match string, match_type string, confidence string, top_job_titles string, jsonl_files string"
    return spark.read.schema(kind).option("header", True).csv(path)


@query(
    f"""
    with {AUDITED}, {_ITEMS.strip()}, r as (select distinct o, st from items)
    select count(*) filter (where st <> 'P')::bigint as total_records_scanned, count(*) filter (where st = 'P')::bigint as skipped_error_records,
    (select count(*) from c)::bigint as total_unique_skills, (select count(match_type) from m)::bigint as taxonomy_matched,
    (select count(*) from m where match_type is null)::bigint as novel from r
    """
)
def audit_totals(spark, sf_dir):
    """[AG-05] the totals of an audit over the records file."""
    return discovery.audit_totals(_audited(spark, sf_dir), _records(spark, sf_dir))


@query("select sha256(string_agg(r_name || chr(10), '' order by r_name)) as sha256 from region")
def file_hash(spark, sf_dir):
    """[IO-10]"""
    path = _file(spark, "hashed")
    V.table(spark, sf_dir, "region").select("r_name").coalesce(1).sortWithinPartitions("r_name").write.text(path)
    return stores.content_hash(spark, path + "/*.txt").select("sha256")


@query("select 'second' as run_id, 2 as at, n_name as what from nation where n_nationkey >= 12")
def latest_report(spark, sf_dir):
    """[IO-16, IO-07] an append-only log of two runs, and the rows of the latest."""
    path = _file(spark, "log")
    n = V.table(spark, sf_dir, "nation")
    for run, at, part in (("first", 1, n.filter("n_nationkey < 12")), ("second", 2, n.filter("n_nationkey >= 12"))):
        stores.write_json_lines(part.select(F.lit(run).alias("run_id"), F.lit(at).alias("at"), F.col("n_name").alias("what")), path, append=True)
    return stores.latest_report(spark.read.schema("run_id string, at int, what string").json(path))


@query(f"with {NODES} select grp, super_grp, count(*)::bigint as n, sum(total_count)::bigint as total from nodes group by 1, 2")
def universe_nodes(spark, sf_dir):
    """[IO-19] the node graph of each region as one document, written and read back."""
    path = _file(spark, "universe")
    n = V.skill_nodes(spark, sf_dir)
    entry = F.struct("skill", F.struct("total_count", F.col("grp").alias("group"), F.col("super_grp").alias("super_group"), F.lit(0).cast("bigint").alias("senior_count")).alias("v"))
    docs = n.groupBy("super_grp").agg(F.map_from_entries(F.collect_list(entry)).alias("nodes"))  # one document holds them by definition
    docs.select("super_grp", F.to_json(F.struct("nodes")).alias("value")).write.partitionBy("super_grp").text(path)
    nodes, _links = stores.read_universe(spark, path)
    return nodes.groupBy("grp", "super_grp").agg(F.count(F.lit(1)).alias("n"), F.sum("total_count").alias("total"))


# --- stores ----------------------------------------------------------------------------------------------------------
@query(
    """
    with n as (select n_name from nation), r as (select r_name from region)
    select 'root' as location, 'root must be an object' as reason from r
    union all select 'group:bad', 'group must be an object' from n
    union all select 'group:' || n_name || '.canonical:text', 'aliases must be an array' from n
    union all select 'group:' || n_name || '.canonical: ', 'canonical must not be blank' from n
    union all select 'group:' || n_name || '.canonical:some.alias:1', 'alias must be non-blank text' from n
    union all select 'group:' || n_name || '.canonical:some.alias:2', 'alias must be non-blank text' from n
    """
)
def store_breaches(spark, sf_dir):
    """[L1-001]"""
    n = V.table(spark, sf_dir, "nation").select(F.concat(F.lit('{"bad": 5, "'), "n_name", F.lit('": {"some": ["ok", " ", 3], "text": "x", " ": []}}')).alias("value"))
    r = V.table(spark, sf_dir, "region").select(F.lit("[1]").alias("value"))
    return stores.schema_breaches(n.unionByName(r))


@query(
    """
    select n_name as grp, 'some' as canonical, 'ok' as alias from nation union all select n_name, 'none', null from nation union all
    select n_name, 'text', null from nation
    """
)
def permissive_store(spark, sf_dir):
    """[IO-02, CJ-01] groups and alias lists that are malformed are left out."""
    n = V.table(spark, sf_dir, "nation").select(F.concat(F.lit('{"bad": 5, "'), "n_name", F.lit('": {"some": ["ok"], "text": "x", "none": []}}')).alias("value"))
    path = _file(spark, "store")
    n.write.text(path, lineSep="\n")
    return stores.flatten_store(spark.read.text(path)).select("grp", "canonical", "alias")


@query(
    f"""
    with {CANON}, s as (select grp, canonical, list(alias) al from tax group by 1, 2) select lower(grp) as grp, lower(canonical) as
    canonical, array_to_string(list_sort(list_transform(al, lambda x: lower(x))), '|') as aliases from s
    """
)
def store_sort(spark, sf_dir):
    """[ST-01]"""
    s = stores.sorted_store(V.tax(spark, sf_dir))
    return s.select(F.lower("grp").alias("grp"), F.lower("canonical").alias("canonical"), F.lower(F.array_join("aliases", "|")).alias("aliases"))


@query(
    f"""
    with {CANON}, o as (select canonical, min(alias) alias from tax group by 1), w as (select canonical, max(alias) || '!' alias from
    tax where grp <> 'ECONOMY' group by 1) select coalesce(w.canonical, o.canonical) as canonical, coalesce(w.alias, o.alias) as alias
    from o full join w using (canonical)
    """
)
def merged_pairs(spark, sf_dir):
    """[SO-08, IO-15]"""
    t = V.tax(spark, sf_dir)
    new = t.filter("grp <> 'ECONOMY'").groupBy("canonical").agg(F.concat(F.max("alias"), F.lit("!")).alias("alias"))
    return rules.merged_pairs(t.groupBy("canonical").agg(F.min("alias").alias("alias")), new)


# --- rules and the rewritten store -----------------------------------------------------------------------------------
@query(
    """
    with n as (select distinct p_type as grp, lower(p_type) as canonical from part) select 'L1-012' as rule_id, 'group:' || grp ||
    '.canonical:' || canonical as location, canonical as observed_value from n
    """
)
def l1_012_self_group(spark, sf_dir):
    """[L1-012]"""
    t = V.tax(spark, sf_dir)
    own = t.select("grp", "grp_pos", F.lower("grp").alias("canonical"), "canonical_pos", "alias", "alias_pos")
    return rules.self_groups(t.unionByName(own)).select("rule_id", "location", "observed_value")


@query(
    f"""
    with {ODD} select distinct 'L1-010' as rule_id, 'group:g' || (p_partkey % 5) || '.canonical:' || name as location, name as
    observed_value from odd where p_partkey % 7 in (3, 5)
    """
)
def l1_010_no_rewrite(spark, sf_dir):
    """[L1-010]"""
    return rules.without_rewrite(_odd_terms(spark, sf_dir)).select("rule_id", "location", "observed_value").distinct()


_REWRITTEN = f"""
    {ODD}, o as (select p_partkey % 7 k, 'g' || (p_partkey % 5) grp, name, p_brand b, p_name n, p_type t from odd join part using (p_partkey)),
    w as (
        select grp, b as canonical, null as alias, 'split_on_slash' as action from o where k = 0
        union select grp, n, null, 'split_on_slash' from o where k = 0
        union select grp, n, b, 'remove_parentheses' from o where k = 1
        union select grp, n, null, 'split_on_and' from o where k = 2
        union select grp, t, null, 'split_on_and' from o where k = 2
        union select grp, n, null, 'split_on_comma' from o where k = 4
        union select grp, t, null, 'split_on_comma' from o where k = 4
        union select grp, name, null, 'needs_exception' from o where k in (3, 5)
        union select grp, name, null, 'keep' from o where k = 6
    )
"""


@query(f"with {_REWRITTEN} select * from w")
def rewritten_store(spark, sf_dir):
    """[GV-05, GV-06, GV-07, SO-03, CJ-08, CJ-09]"""
    return rules.rewritten_terms(_odd_terms(spark, sf_dir)).select("grp", "canonical", "alias", "action").distinct()


@query(
    f"""
    with {_REWRITTEN}, c as (select distinct grp, canonical, {NORM.format('canonical')} cn from w),
    l as (select cn, count(*) n from c group by 1)
    select 'L1R-002' as rule_id, cn as normalized_value from l where n > 1
    union all select 'L1R-006', cn from c where regexp_matches(cn, '^(core|advanced|basic|modern|enterprise|backend|frontend) ') or {VERSION.format('cn')}
    """
)
def rewritten_findings(spark, sf_dir):
    """[L1R-002, L1R-006, JN-05]"""
    found = rules.rewritten_findings(rules.rewritten_terms(_odd_terms(spark, sf_dir)))
    return found.filter("rule_id in ('L1R-002', 'L1R-006')").select("rule_id", "normalized_value")


@query(
    """
    with t as (select a.n_name as grp, case s_suppkey % 4 when 0 then b.n_name when 1 then ' ' else s_name end as canonical,
        case s_suppkey % 3 when 0 then '  ' when 1 then 'also ' || s_suppkey end as alias
        from supplier join nation a on s_nationkey = a.n_nationkey join nation b on b.n_nationkey = (s_nationkey + 1) % 25)
    select distinct 'L1R-001' as rule_id, 'group:' || grp || '.canonical:' || canonical as location from t where trim(canonical) = ''
    union all select distinct 'L1R-001', 'group:' || grp || '.canonical:' || canonical || '.alias:' || alias from t where trim(alias) = ''
    union all select distinct 'L1R-005', lower(grp) from t where lower(grp) in (select lower(canonical) from t where lower(canonical) <> lower(grp))
    """
)
def rewritten_breaches(spark, sf_dir):
    """[L1R-001, L1R-005, JN-05] a store with blank names, and with suppliers named after the next nation."""
    n = V.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    after = n.select(F.pmod(F.col("n_nationkey") - 1, F.lit(25)).alias("n_nationkey"), F.col("n_name").alias("after"))
    s = V.table(spark, sf_dir, "supplier").join(n.join(after, "n_nationkey"), F.col("s_nationkey") == F.col("n_nationkey"))
    k = F.col("s_suppkey")
    name = F.when(k % 4 == 0, F.col("after")).when(k % 4 == 1, " ").otherwise(F.col("s_name"))
    alias = F.when(k % 3 == 0, "  ").when(k % 3 == 1, F.concat(F.lit("also "), k.cast("string")))
    terms = s.select(F.col("n_name").alias("grp"), F.lit(0).alias("grp_pos"), name.alias("canonical"), F.lit(0).alias("canonical_pos"), alias.alias("alias"), k.cast("int").alias("alias_pos"))
    found = rules.rewritten_findings(terms).filter("rule_id in ('L1R-001', 'L1R-005')")
    return found.select("rule_id", F.when(F.col("rule_id") == "L1R-005", F.col("normalized_value")).otherwise(F.col("location")).alias("location"))


@query(
    f"""
    with tax0 as ({TAX}), tax as (select grp, canonical, alias, pos, gn, cn, an from tax0 union all select grp, alias, canonical, pos, gn, an, cn from tax0),
    canon as (select distinct grp, canonical, gn, cn from tax where gn <> cn), ali as (select * from tax where alias is not null and gn <> cn)
    select 'L1R-003' as rule_id, an as normalized_value from (select distinct an from ali where an in (select cn from canon))
    union all select 'L1R-004', an from ali group by an having count(distinct cn) > 1
    union all select 'L1R-009', an from (select an, row_number() over (partition by grp, canonical, an order by pos) nth from ali) where nth > 1
    """
)
def rewritten_alias_findings(spark, sf_dir):
    """[L1R-003, L1R-004, L1R-009, JN-05]"""
    found = rules.rewritten_findings(_mirrored(V.tax(spark, sf_dir)))
    return found.filter("rule_id in ('L1R-003', 'L1R-004', 'L1R-009')").select("rule_id", "normalized_value")


@query(f"with {CANON} select distinct grp, canonical, alias from ali where (cn, an) in (select cn, min(an) from ali group by 1)")
def removed_aliases(spark, sf_dir):
    """[L1-007, L1-008, GV-07]"""
    t = V.tax(spark, sf_dir)
    return rules.removed_aliases(t, t.groupBy("canonical").agg(F.min("alias").alias("alias")))


@query(
    f"""
    with {CANON}, d as (select cn v from canon group by cn having count(*) > 1), r as (select an v, nth from (select an, row_number() over (partition by grp, canonical, an order by pos) nth from ali) where nth > 1),
    f as (select 'L1-002' rule_id, 'error' sev, 'merge_duplicates' act, 'canonical occurs more than once' rea, v from d union all select 'L1-009', 'warning', 'remove_alias', 'alias is repeated', alias from (select alias, row_number() over (partition by grp, canonical, an order by pos) nth from ali) where nth > 1),
    k as (select 'rule' as kind, rule_id as value, v from f union all select 'severity', sev, v from f union all select 'action', act, v from f union all select 'reason', rea, v from f)
    select kind, value, count(*)::bigint as n, array_to_string(list_sort(list(distinct v))[1:3], ' | ') as examples from k group by 1, 2
    """
)
def findings_report(spark, sf_dir):
    """[AG-02, FN-40]"""
    t = V.tax(spark, sf_dir)
    return rules.findings_by(rules.duplicate_canonicals(t).unionByName(rules.repeated_aliases(t)))


@query(f"with {CANON}, f as (select {{at}} as location from (select grp, canonical, row_number() over (partition by grp, canonical, an order by pos) nth from ali) where nth > 1) select location, count(*)::bigint as count from f group by 1 order by 2 desc, 1 limit 10".format(at="'group:' || grp || '.canonical:' || canonical"))
def top_locations(spark, sf_dir):
    """[AG-02, ST-03, ST-08]"""
    return rules.top_locations(rules.repeated_aliases(V.tax(spark, sf_dir)))


# --- graph and anomaly -----------------------------------------------------------------------------------------------
@query(
    f"""
    with {JD}, b as (select a node, b other, weight from edges union all select b, a, weight from edges), r as (select *, row_number()
    over (partition by node order by weight desc, other)::int as rank from b) select node, rank, other, weight from r where rank <= 10
    """
)
def ranked_neighbours(spark, sf_dir):
    """[ST-09]"""
    return graph.neighbours(graph.cooccurrence(V.jd_skill(spark, sf_dir)))


@query(
    f"""
    with {JD}, s as (select node from (select node, count(*) n from (select a node from edges union all select b from edges) group by
    1) order by n desc, node limit 5) select a, b, weight, a in (select node from s) or b in (select node from s) as suspect from
    edges
    """
)
def hub_flags(spark, sf_dir):
    """[JN-21]"""
    e = graph.cooccurrence(V.jd_skill(spark, sf_dir))
    return graph.hub_flags(e, graph.degrees(e).orderBy(F.desc("degree"), "node").limit(5).select(F.upper("node").alias("name")))


@query(
    f"""
    with {GRAMS}, e as (select a, b, round(score, 6) w from sim where score >= 0.5), d as (select node, count(*) degree, sum(w) total, max(w) m from (select a node, w from e union all select b, w from e) group by 1),
    mem as (select distinct p_brand as cl, p_name as term from part), lv as (select p_name as term, min(p_type) as level from part group by 1), r as (select cl, term, level from mem join lv using (term)),
    c as (select cl, level, count(*) n, min(term) f from r group by 1, 2), mj as (select cl, level as majority from (select *, row_number() over (partition by cl order by n desc, f, level) nth from c) where nth = 1)
    select 'L5-001' as rule_id, true as blocking, node as term from d where degree / ((select count(*) from d) - 1) > 0.05
    union all select 'L5-002', false, node from d where degree = 1 and m / total >= 0.9
    union all select 'L5-003', false, term from r join mj using (cl) where level <> majority
    """
)
def graph_findings(spark, sf_dir):
    """[GR-07, L5-001..L5-003] the three checks together."""
    e = _sim_edges(spark, sf_dir)
    p = V.table(spark, sf_dir, "part")
    members = p.select(F.col("p_brand").alias("cluster"), F.col("p_name").alias("term")).distinct()
    levels = p.groupBy(F.col("p_name").alias("term")).agg(F.min("p_type").alias("level"))
    return graph.graph_findings(e, members, levels, 0.05)


@query("with s as (" + _group_sql("median(x)", "mad(x) * 1.4826") + "), r as (select skill, total_count, suspicion_score, row_number() over (order by suspicion_score desc, total_count desc, skill)::int as rank from s) select * from r where rank <= 15")
def top_outliers(spark, sf_dir):
    """[ST-06, ST-08]"""
    return anomaly.top_outliers(anomaly.group_outliers(V.skill_nodes(spark, sf_dir)), "suspicion_score", 15).select("skill", "total_count", "suspicion_score", "rank")


@query("with s as (" + _group_sql("median(x)", "mad(x) * 1.4826") + "), r as (select verdict, skill, row_number() over (partition by verdict order by suspicion_score desc, total_count desc, skill)::int as rank from s) select * from r where rank <= 12")
def verdict_leaders(spark, sf_dir):
    """[ST-06, ST-08]"""
    return anomaly.by_verdict(anomaly.group_outliers(V.skill_nodes(spark, sf_dir))).select("verdict", "skill", "rank")


@query(f"with {NODES} select skill, total_count, grp, super_grp, min(c_mktsegment) as label from nodes join customer on c_name = skill group by all")
def labelled_nodes(spark, sf_dir):
    """[AN-05]"""
    labels = V.table(spark, sf_dir, "customer").select(F.upper("c_name").alias("name"), F.col("c_mktsegment").alias("label"))
    return anomaly.with_labels(V.skill_nodes(spark, sf_dir), labels)


@query(
    f"""
    with {GRAMS}, v as (select term, [length(term), length(term) - length(replace(term, 'a', '')), length(term) - length(replace(term, 'e', ''))]::double[] vec from terms),
    near as (select distinct x.term a, y.term b from g x join g y on x.gram = y.gram and x.term < y.term),
    s as (select a, b, list_dot_product(x.vec, y.vec) / (sqrt(list_dot_product(x.vec, x.vec)) * sqrt(list_dot_product(y.vec, y.vec))) score from near join v x on x.term = a join v y on y.term = b)
    select a as "left", b as "right", round(score, 6) as score, case when score > 0.99 then 'high_collision' else 'possible_conflict' end as band from s where score >= 0.97
    """
)
def dense_edges(spark, sf_dir):
    """[SM-04, SM-03, JN-08] edges by dense cosine between names that share a trigram, with a stand-in for the model."""
    t = V.table(spark, sf_dir, "part").select(F.col("p_name").alias("term")).distinct()
    return similarity.dense_edges(t, providers.embedded(t, "term", lambda: _letters), 0.97, 0.99)


def _letters(texts: list[str]) -> list[list[float]]:
    return [[float(len(t)), float(t.count("a")), float(t.count("e"))] for t in texts]


@query("with d as (" + ORACLE["dense_nearest"] + ") select id, best_score >= 0.45 as is_alias, case when best_score >= 0.45 then best_id end as alias_of from d")
def alias_verdicts(spark, sf_dir):
    """[SM-10]"""
    v = V.vectors(spark, sf_dir)
    return similarity.alias_verdicts(similarity.dense_nearest(v, v), 0.45)


@query(
    f"""
    with {ODD}, d as (select distinct cast(p_partkey % 9 as varchar) as cluster_id, name as term, p_partkey % 7 as k from odd),
    c as (select distinct p_name || ' ' || p_brand as term from part where p_size % 2 = 1 and p_size % 5 in (1, 4))
    select 'arbitration' as section, count(*)::bigint as n from d where k = 0 union all select 'classification', count(*)::bigint from c
    """
)
def changed_sections(spark, sf_dir):
    """[PD-11, AG-25, GV-14] decisions that were blocked or changed, and classes under review."""
    canon = V.table(spark, sf_dir, "part").select(F.col("p_name").alias("canonical")).distinct()
    m = _members(spark, sf_dir).distinct()
    made = governance.governed(governance.heuristic_arbitration(m), m, canon)
    changed = made.filter(F.col("blocked") | ~F.col("requested_action").eqNullSafe(F.col("effective_action")))
    low = governance.normalised_classes(_raw_classes(spark, sf_dir)).filter("status = 'under_review'").select("term").distinct()
    n = F.count(F.lit(1)).alias("n")
    return changed.agg(n).withColumn("section", F.lit("arbitration")).unionByName(low.agg(n).withColumn("section", F.lit("classification")))


# --- discovery -------------------------------------------------------------------------------------------------------
@query(
    f"""
    with {MENTION}, t as (select key, tag, count(*) n from m group by 1, 2), r as (select *, row_number() over (partition by key order
    by n desc, tag) nth from t) select key, array_to_string(list(tag order by nth), ',') as tags from r where nth <= 3 group by 1
    """
)
def top_tags(spark, sf_dir):
    """[AG-16]"""
    q = discovery.queue_delta(V.mentions(spark, sf_dir))
    return q.select("key", F.array_join(discovery.top_tags(F.col("tags")), ",").alias("tags"))


@query(
    """
    select c_nationkey as nation, array_to_string(list(c_name order by c_custkey)[1:6], ', ') || case when count(*) > 6 then ', ...'
    else '' end || ' (' || count(*) || ' total)' as context from customer group by 1
    """
)
def group_context(spark, sf_dir):
    """[CJ-07]"""
    c = V.table(spark, sf_dir, "customer")
    t = c.select(F.col("c_nationkey").cast("string").alias("grp"), F.col("c_name").alias("canonical"), F.col("c_custkey").alias("canonical_pos"))
    return discovery.group_context(t).select(F.col("grp").cast(c.schema["c_nationkey"].dataType).alias("nation"), "context")


@query(
    """
    with r as (select upper(p_name) k, arg_min(p_type, p_partkey) grp from part group by 1) select p_name as skill, grp from (select
    distinct p_name from part) join r on upper(p_name) = k union all select r_name, null from region
    """
)
def matched_replies(spark, sf_dir):
    """[JN-18, UD-06] a batch with names that no reply has."""
    p = V.table(spark, sf_dir, "part")
    batch = p.select(F.col("p_name").alias("skill")).distinct().unionByName(V.table(spark, sf_dir, "region").select(F.col("r_name").alias("skill")))
    reply = p.select(F.concat(F.lit(" "), F.upper("p_name")).alias("skill"), F.col("p_partkey").alias("pos"), F.col("p_type").alias("grp"))
    return discovery.matched_replies(batch, reply)


@query("select p_partkey from part where p_brand not in (select min(p_brand) from part group by p_type)")
def still_to_do(spark, sf_dir):
    """[JN-16, JN-17, SS-03..SS-05, SS-07] what a resumed run has left, of a state whose stale rows don't count."""
    p = V.table(spark, sf_dir, "part")
    state = p.groupBy("p_type").agg(F.min("p_brand").alias("p_brand")).withColumn("input_hash", F.lit("now"))
    stale = p.select("p_type", "p_brand").distinct().withColumn("input_hash", F.lit("then"))
    return discovery.remaining(p, discovery.live_state(state.unionByName(stale), "now"), "p_brand").select("p_partkey")


@query(
    """
    with a as (select p_partkey pos, p_name || p_partkey skill, case p_partkey % 3 when 0 then 'NEW: ' || lower(p_type) when 1 then
    'new:' || p_type end assigned from part) select arg_min(trim(substr(assigned, 5)), pos) as suggested_group, count(*)::bigint as n
    from a where assigned is not null group by lower(trim(substr(assigned, 5)))
    """
)
def new_groups(spark, sf_dir):
    """[AG-24]"""
    p, k = V.table(spark, sf_dir, "part"), F.col("p_partkey") % 3
    assigned = F.when(k == 0, F.concat(F.lit("NEW: "), F.lower("p_type"))).when(k == 1, F.concat(F.lit("new:"), "p_type")).otherwise("Existing")
    rows = p.select(F.col("p_partkey").alias("pos"), F.concat("p_name", F.col("p_partkey").cast("string")).alias("skill"), assigned.alias("assigned"))
    return discovery.consolidated_groups(rows).select("suggested_group", F.size(F.split("skills", ", ")).cast("bigint").alias("n"))


@query(
    """
    select case p_partkey % 5 when 0 then 'failed' when 1 then 'rejected' when 2 then 'new' when 3 then 'existing' else 'new' end as
    section, count(*)::bigint as n from part group by 1
    """
)
def assignment_sections(spark, sf_dir):
    """[GV-12]"""
    k = F.col("p_partkey") % 5
    given = F.when(k == 0, " ").when(k == 1, "Reject: no skill").when(k == 2, "NEW: Ops").when(k == 3, F.col("p_type")).otherwise("Unheard of")
    return V.table(spark, sf_dir, "part").select(discovery.assignment_section(given, k == 3).alias("section")).groupBy("section").agg(F.count(F.lit(1)).alias("n"))


@query("select distinct p_name as canonical, lower(p_brand) as alias from part union select distinct p_name, p_type from part")
def applied_aliases(spark, sf_dir):
    """[JN-15, GV-11] aliases that an applied review adds; one equal to its target adds nothing."""
    p = V.table(spark, sf_dir, "part")
    row = lambda name, target: p.select(F.lit("G").alias("suggested_group"), name.alias("display_name"), F.concat(F.lit("alias_of:"), target).alias("action"))
    rows = row(F.lower("p_brand"), F.col("p_name")).unionByName(row(F.col("p_type"), F.col("p_name"))).unionByName(row(F.upper("p_name"), F.col("p_name")))
    return discovery.applied(rows)[1].distinct()


@query("select p_partkey, lower(p_name) as low from (select min(p_partkey) p_partkey, p_name from part group by p_name)")
def distinct_candidates(spark, sf_dir):
    """[SO-05]"""
    p = V.table(spark, sf_dir, "part")
    return p.groupBy("p_name").agg(F.min("p_partkey").alias("p_partkey")).select("p_partkey", F.lower("p_name").alias("low"))


# --- governance ------------------------------------------------------------------------------------------------------
_RAW = """
    raw as (select distinct p_name || ' ' || p_brand as term, case p_size % 6 when 0 then 'standards paper' when 1 then 'PROTOCOL' when 2 then 'concepts' when 3 then 'soft skills' when 4 then 'Algorithm' else 'what' end as nature,
            case p_size % 4 when 0 then 'web framework' when 1 then ' ' when 2 then 'rfc text' else 'Technology' end as kind,
            case p_size % 3 when 0 then ' domain' when 1 then 'Method' else 'thing' end as level,
            case p_size % 5 when 0 then 'very high' when 1 then '0.3' when 2 then 'x' when 3 then '0.85' else 'low' end as conf,
            case p_size % 2 when 0 then 'ACTIVE' else '?' end as st, p_size from part)
"""


def _any(words) -> str:
    return "(" + " or ".join(f"contains(txt, '{w}')" for w in words) + ")"


_INFERRED = " ".join(f"when {_any(words)} then '{nature}'" for nature, words in governance.NATURE_MARKERS)


@query(
    f"""
    with {_RAW}, a as (select *, case when trim(kind) = '' then term else trim(kind) end as pt from raw), b as (select *, lower(pt || ' ' || term) as txt from a),
    c as (select *, case p_size % 6 when 0 then 'Standard / Specification' when 1 then 'Protocol' when 2 then 'Concept' when 3 then 'Human Skill' when 4 then 'Algorithm' else case {_INFERRED} else 'Software Artifact' end end as nat from b)
    select distinct term, nat as ontological_nature, pt as primary_type,
           case p_size % 3 when 0 then 'Domain' when 1 then 'Method' else case when nat in ('Algorithm', 'Standard / Specification', 'Protocol') then 'Method' when nat in ('Concept', 'Human Skill') then 'Domain'
                when {_any(governance.CONCRETE_MARKERS)} then 'Concrete' when {_any(governance.METHOD_MARKERS)} then 'Method' else 'Concrete' end end as abstraction_level,
           case p_size % 5 when 0 then 'HIGH' when 1 then 'LOW' when 2 then 'MEDIUM' when 3 then 'HIGH' else 'LOW' end as confidence,
           case when p_size % 2 = 0 then 'active' when p_size % 5 in (1, 4) then 'under_review' else 'active' end as status
    from c
    """
)
def normalised_classes(spark, sf_dir):
    """[GV-08, GV-09, FN-27, FN-28, FN-32..FN-35]"""
    return governance.normalised_classes(_raw_classes(spark, sf_dir)).distinct()


@query(
    """
    with p as (select p_name || ' ' || p_partkey as canonical, p_type as grp, p_brand, p_size, p_partkey from part)
    select canonical, p_brand as aliases, grp as tag, 'Back end|' || p_brand || case when p_size % 2 = 0 then '|api' else '' end as roles,
           p_size % 4 in (0, 2) as is_contextual, p_partkey % 2 = 1 as is_versioned, false as is_marketing_language,
           case p_size % 5 when 0 then 'HIGH' when 1 then 'LOW' when 2 then 'MEDIUM' when 3 then 'HIGH' else 'LOW' end as confidence,
           case when p_size % 2 = 0 then 'active' when p_size % 5 in (1, 4) then 'under_review' else 'active' end as status
    from p
    """
)
def class_records(spark, sf_dir):
    """[GV-08, GV-09, FN-29, FN-36] roles and flags of classifications, and the records that carry them."""
    z = lambda n, *v: F.element_at(F.array(*map(F.lit, v)), (F.col("p_size") % n + 1).cast("int"))
    p = V.table(spark, sf_dir, "part").withColumn("term", F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")))
    roles = F.array(F.lit("Back end "), F.col("p_brand"), F.lit("BACK END"), F.lit(" "), F.lit(None), F.when(F.col("p_size") % 2 == 0, "api"), F.lower("p_brand"))
    given = p.select(
        "term",
        z(6, "standards paper", "PROTOCOL", "concepts", "soft skills", "Algorithm", "what").alias("ontological_nature"),
        z(4, "web framework", " ", "rfc text", "Technology").alias("primary_type"),
        z(3, " domain", "Method", "thing").alias("abstraction_level"),
        z(5, "very high", "0.3", "x", "0.85", "low").alias("confidence"),
        z(2, "ACTIVE", "?").alias("status"),
        roles.alias("functional_roles"),
        z(4, "Yes", "0", "TRUE", "maybe").alias("is_contextual"),
        (F.col("p_partkey") % 2 == 1).alias("is_versioned"),
        F.lit(None).cast("string").alias("is_marketing_language"),
    )
    terms = p.select(F.col("p_type").alias("grp"), F.col("term").alias("canonical"), F.col("p_brand").alias("alias"))
    out = governance.class_records(governance.normalised_classes(given), terms)
    return out.select("canonical", F.array_join("aliases", "|").alias("aliases"), F.col("tags")[0].alias("tag"), F.array_join("classification.functional_roles", "|").alias("roles"), *governance.FLAGS, "confidence", "status")


def _raw_classes(spark, sf_dir) -> DataFrame:
    z = lambda n, *v: F.element_at(F.array(*map(F.lit, v)), (F.col("p_size") % n + 1).cast("int"))
    return V.table(spark, sf_dir, "part").select(
        F.concat_ws(" ", "p_name", "p_brand").alias("term"),
        z(6, "standards paper", "PROTOCOL", "concepts", "soft skills", "Algorithm", "what").alias("ontological_nature"),
        z(4, "web framework", " ", "rfc text", "Technology").alias("primary_type"),
        z(3, " domain", "Method", "thing").alias("abstraction_level"),
        z(5, "very high", "0.3", "x", "0.85", "low").alias("confidence"),
        z(2, "ACTIVE", "?").alias("status"),
    ).distinct()


@query(
    """
    with d as (select distinct s_name || ' vision' as term, s_suppkey % 3 k from supplier)
    select term, case when k < 2 then 'Concept' else 'Software Artifact' end as ontological_nature, case when k < 2 then term else 'camera' end as primary_type, case when k < 2 then 'Domain' else 'Concrete' end as abstraction_level from d
    """
)
def domain_overrides(spark, sf_dir):
    """[FN-34, FN-33]"""
    k = F.col("s_suppkey") % 3
    none = F.lit(None).cast("string")
    kind = F.when(k == 0, "Technology").when(k == 1, " general ").otherwise("camera")
    rows = V.table(spark, sf_dir, "supplier").select(F.concat("s_name", F.lit(" vision")).alias("term"), none.alias("ontological_nature"), kind.alias("primary_type"), none.alias("abstraction_level"), F.lit("HIGH").alias("confidence"), none.alias("status")).distinct()
    return governance.normalised_classes(rows).select("term", "ontological_nature", "primary_type", "abstraction_level")


@query("select s_suppkey, case s_suppkey % 4 when 0 then s_name when 1 then s_name when 2 then s_name end as value from supplier")
def folded_values(spark, sf_dir):
    """[FN-30]"""
    k = F.col("s_suppkey") % 4
    key = F.when(k == 0, " Type ").when(k == 1, "KIND").when(k == 2, "kind").otherwise("other")
    payload = F.create_map(key, F.col("s_name"))
    return V.table(spark, sf_dir, "supplier").select("s_suppkey", S.folded_value(payload, "type", "kind").alias("value"))


@query(
    """
    select s_suppkey, case s_suppkey % 4 when 3 then null else s_name end as primary_type,
           case s_suppkey % 4 when 0 then '{"type": "' || s_name || '"}' when 1 then '["' || s_name || '"]' when 2 then '{"b": {"NAME": "' || s_name || '"}}' end as json
    from supplier
    """
)
def model_json(spark, sf_dir):
    """[FN-31, FN-37] lenient JSON and the type found in it."""
    k = F.col("s_suppkey") % 4
    n = F.col("s_name")
    raw = (
        F.when(k == 0, F.concat(F.lit('```json\n{"type":  "'), n, F.lit('"}\n```')))
        .when(k == 1, F.concat(F.lit('I think ["'), n, F.lit('"] fits')))
        .when(k == 2, F.concat(F.lit('Answer: {"b": {"NAME": "'), n, F.lit('"}} done')))
        .otherwise("no answer")
    )
    rows = V.table(spark, sf_dir, "supplier").select("s_suppkey", raw.alias("raw"))
    return rows.select("s_suppkey", udfs.primary_type_udf(F.col("raw")).alias("primary_type"), udfs.lenient_json_udf(F.col("raw")).alias("json"))


@query("select n_name as term, 'Databases, Tools' as roles, 'Kafka' as alias_of, 2 as rows from nation")
def model_rows(spark, sf_dir):
    """[FN-36, FN-38, FN-39] roles, the alias answer and the rows of model text."""
    text = F.lit('<think>maybe [1]</think>```json\n[{"skill": "a", "ok": True}, {"is_alias": None, "alias_of": "Kafka"}, {"cut": ')
    roles = F.lit('["Databases", " databases ", 3, "Tools", ""]')
    n = V.table(spark, sf_dir, "nation").select(F.col("n_name").alias("term"), text.alias("text"), roles.alias("roles"))
    return n.select("term", F.array_join(udfs.functional_roles_udf(F.col("roles")), ", ").alias("roles"), udfs.alias_answer_udf(F.col("text")).alias("alias_of"), F.size(udfs.lenient_rows_udf(F.col("text"))).alias("rows"))


@query(
    """
    select p_partkey, 'group:' || p_type || '.canonical:' || p_name as location, case when p_size > 25 then 'error' else 'warning' end
    as severity from part
    """
)
def locations(spark, sf_dir):
    """[FN-43, FN-40]"""
    p = V.table(spark, sf_dir, "part")
    return p.select("p_partkey", S.location(F.col("p_type"), F.col("p_name")).alias("location"), S.severity(F.col("p_size") > 25).alias("severity"))


@query(
    """
    with r as (select n_nationkey k, 'c' || n_nationkey as id from nation)
    select 'L3-001' as rule_id, 'cluster:' || id as location from r where k % 4 in (0, 1)
    union all select 'L3-001', 'cluster:' || id || '|term:<invalid_row>' from r where k % 4 = 2
    """
)
def reply_findings(spark, sf_dir):
    """[L3-001, UD-01] findings on replies: no JSON, no list, a row that is no object, sound ones."""
    return replies.decisions(_replies(spark, sf_dir))[1].select("rule_id", "location")


def _replies(spark, sf_dir) -> DataFrame:
    k = F.col("n_nationkey") % 4
    one = '{"term": "t", "action": "KEEP_DISTINCT", "confidence": "HIGH", "split_candidates": ["a"], "reasoning": {"ecosystem": "Same"}}'
    text = F.when(k == 0, "no json").when(k == 1, '{"decisions": {}}').when(k == 2, f'{{"decisions": [3, {one}]}}').otherwise(f'{{"decisions": [{one}]}}')
    return V.table(spark, sf_dir, "nation").select(F.concat(F.lit("c"), F.col("n_nationkey").cast("string")).alias("cluster_id"), text.alias("reply"))


@query(
    """
    select 'c' || n_nationkey as cluster_id, 't' as term, 'KEEP_DISTINCT' as action, 'HIGH' as confidence, 'a' as candidates, 'Same'
    as ecosystem from nation where n_nationkey % 4 > 1
    """
)
def reply_decisions(spark, sf_dir):
    """[IO-12, IO-13, L3-001]"""
    d = replies.decisions(_replies(spark, sf_dir))[0]
    return d.select("cluster_id", "term", "action", "confidence", F.array_join("split_candidates", ",").alias("candidates"), "ecosystem")


_KINDS = (
    ("L4-001", "['list']"),
    ("L4-002", '{"classification": {"functional_roles": {"a": 1}}}'),
    ("L4-003", '{"classification": {"ontological_nature": "Concept"}, "confidence": "low"}'),
    ("L4-004", '{"ontological_nature": "COMPOSITE STACK"}'),
    ("L4-005", '{"classification": {"ontological_nature": "category"}}'),
    (None, '{"classification": {"ontological_nature": "Concept", "functional_roles": ["x"]}, "confidence": "HIGH", "is_versioned": false}'),
)


@query(
    """
    select case s_suppkey % 6 when 0 then 'L4-001' when 1 then 'L4-002' when 2 then 'L4-003' when 3 then 'L4-004' else 'L4-005' end as
    rule_id, 'term:' || s_name as location, s_suppkey % 6 < 2 as blocking from supplier where s_suppkey % 6 < 5
    """
)
def class_findings(spark, sf_dir):
    """[L4-001..L4-005]"""
    return replies.classes(_class_replies(spark, sf_dir))[1].select("rule_id", "location", "blocking")


def _class_replies(spark, sf_dir) -> DataFrame:
    text = F.element_at(F.array(*[F.lit(t) for _, t in _KINDS]), (F.col("s_suppkey") % 6 + 1).cast("int"))
    return V.table(spark, sf_dir, "supplier").select(F.col("s_name").alias("term"), text.alias("reply"))


@query(
    """
    select s_name as term, 'Concept' as ontological_nature, case s_suppkey % 6 when 2 then 'low' else 'HIGH' end as confidence from
    supplier where s_suppkey % 6 in (2, 5)
    """
)
def class_replies(spark, sf_dir):
    """[IO-13, UD-05]"""
    return replies.classes(_class_replies(spark, sf_dir))[0].select("term", "ontological_nature", "confidence")


@query(
    f"""
    with {ODD}, c as (select distinct p_partkey % 9 as cl, name from odd where p_partkey % 7 = 0)
    select 'L3-002' as rule_id, 'cluster:' || cl || '|term:' || name as location, 'SPLIT_INTO_MULTIPLE_CANONICALS' as observed_value, 'split_target_already_exists_requires_explicit_mapping' as normalized_value from c
    """
)
def violation_findings(spark, sf_dir):
    """[L3-002, GV-01]"""
    canon = V.table(spark, sf_dir, "part").select(F.col("p_name").alias("canonical")).distinct()
    m = _members(spark, sf_dir).distinct()
    made = governance.governed(governance.heuristic_arbitration(m), m, canon)
    return governance.violation_findings(made).select("rule_id", "location", "observed_value", "normalized_value")


@query(
    """
    select distinct term, stage, issue, proposed_action, 'LOW' as confidence from (
        select p_name as term, 3 as stage, 'LOW confidence arbitration' as issue, 'KEEP_DISTINCT' as proposed_action from part where p_size <= 10
        union all select p_name, 4, 'classification under review', p_type from part where p_size > 40
        union all select p_brand, 3, 'alias ends in a canonical', 'remove_alias:' || p_name from part
        union all select p_brand, 3, 'alias resembles a canonical', 'review:' || p_type from part)
    """
)
def review_queue(spark, sf_dir):
    """[SO-01, SO-06, ST-04, PD-11]"""
    p = V.table(spark, sf_dir, "part")
    decisions = p.select(F.col("p_name").alias("term"), F.when(F.col("p_size") <= 10, "LOW").otherwise("HIGH").alias("confidence"), F.lit("KEEP_DISTINCT").alias("requested_action"))
    classes = p.select(F.col("p_name").alias("term"), F.when(F.col("p_size") > 40, "under_review").otherwise("active").alias("status"), F.col("p_type").alias("ontological_nature"))
    suffixes = p.select(F.col("p_brand").alias("alias"), F.col("p_name").alias("matched"))
    advisories = p.select(F.col("p_brand").alias("alias"), F.col("p_type").alias("target_canonical"))
    return governance.review_queue(decisions, classes, suffixes, advisories)


# --- providers and sources -------------------------------------------------------------------------------------------
def _lengths(texts: list[str]) -> list[list[float]]:
    return [[float(len(t)), float(t.count("a"))] for t in texts]


@query("select distinct p_name as term, length(p_name)::double as a, (length(p_name) - length(replace(p_name, 'a', '')))::double as b from part")
def embedded_terms(spark, sf_dir):
    """[UD-02, SM-09, IO-11] the batched source with a stand-in for the model."""
    rows = providers.embedded(V.table(spark, sf_dir, "part").select(F.col("p_name").alias("term")), "term", lambda: _lengths, 16)
    return rows.select("term", F.col("vec")[0].alias("a"), F.col("vec")[1].alias("b"))


@query(
    """
    select p_partkey, md5('Name: ' || p_name) as prompt_md5, case when p_type = 'ECONOMY' then 'known' else upper('Name: ' || p_name)
    end as answer from part where p_name not in (select p_name from part where p_type = 'ECONOMY') union all select p_partkey,
    md5('Name: ' || p_name), 'known' from part where p_name in (select p_name from part where p_type = 'ECONOMY')
    """
)
def answered_prompts(spark, sf_dir):
    """[UD-05..UD-08, SS-09] prompts answered once each, those in the cache not asked."""
    p = V.table(spark, sf_dir, "part").withColumn("prompt", F.concat(F.lit("Name: "), "p_name"))
    cache = p.filter("p_type = 'ECONOMY'").select(F.md5("prompt").alias("prompt_md5"), F.lit("known").alias("answer")).distinct()
    return providers.answered(p, "p_partkey", "prompt", lambda: str.upper, cache)


def _sources(spark, sf_dir) -> DataFrame:
    n = F.col("n_nationkey").cast("string")
    region = F.col("n_regionkey").cast("string")
    body = F.concat(F.lit("import os\nfrom lib"), region, F.lit(" import x\n\ndef f"), n, F.lit("():\n    return g"), region, F.lit("()\n\ndef g"), region, F.lit("():\n    return 1\n"))
    return V.table(spark, sf_dir, "nation").select(F.concat(F.lit("m"), n, F.lit(".py")).alias("file"), body.alias("source"))


@query(
    """
    with n as (select n_nationkey k, n_regionkey r, 'm' || n_nationkey || '.py' as file from nation)
    select file, 'import' as kind, 'os' as name, 1 as first from n union all select file, 'import', 'lib' || r, 2 from n
    union all select file, 'def', 'f' || k, 4 from n union all select file, 'def', 'g' || r, 7 from n
    union all select file, 'chunk', 'f' || k, 4 from n union all select file, 'chunk', 'g' || r, 7 from n
    union all select file, 'call', 'g' || r, 5 from n
    """
)
def source_facts(spark, sf_dir):
    """[CJ-10, GR-08]"""
    return pycode.facts(_sources(spark, sf_dir)).select("file", "kind", "name", "first")


@query("select distinct 'f' || n_nationkey as name from nation")
def uncalled_functions(spark, sf_dir):
    """[SO-04]"""
    return pycode.uncalled(pycode.facts(_sources(spark, sf_dir)))


@query("select 'm' || n_nationkey || '.py' as a, 'os' as b from nation union select 'm' || n_nationkey || '.py', 'lib' || n_regionkey from nation")
def import_edges(spark, sf_dir):
    """[GR-08, GR-09]"""
    return pycode.import_edges(pycode.facts(_sources(spark, sf_dir)))


FILES = """
    f as (select 'pkg/m' || s_suppkey || '.py' as file, s_nationkey nat, s_suppkey k,
        lead(s_suppkey) over w as after, first_value(s_suppkey) over w as first, max(s_suppkey) over (partition by s_nationkey) as last
        from supplier window w as (partition by s_nationkey order by s_suppkey)),
    e as (select file as a, 'pkg/m' || after || '.py' as b from f where after is not null
        union select file, 'pkg/m' || first || '.py' from f where k = last and nat % 2 = 0
        union select 'pkg/hub.py', file from f where k = last union select file, 'pkg/hub.py' from f where k = last and nat = 1)
"""


def _modules(spark, sf_dir) -> DataFrame:
    """A file for each supplier that imports the next of its nation; in even nations the last imports the first."""
    s = V.table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    near = s.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("first"), F.max("s_suppkey").alias("last"))
    after = F.lead("s_suppkey").over(Window.partitionBy("s_nationkey").orderBy("s_suppkey"))
    rows = s.withColumn("after", after).join(near, "s_nationkey")
    line = lambda c: F.concat(F.lit("from pkg.m"), c.cast("string"), F.lit(" import name\n"))
    body = F.when(F.col("after").isNotNull(), line(F.col("after"))).when(F.col("s_nationkey") % 2 == 0, line(F.col("first")))
    body = F.concat(F.lit("import os\n"), F.coalesce(body, F.lit("")), F.when((F.col("s_suppkey") == F.col("last")) & (F.col("s_nationkey") == 1), "import pkg.hub\n").otherwise(""))
    hub = near.agg(F.array_join(F.sort_array(F.collect_list(F.concat(F.lit("import pkg.m"), F.col("last").cast("string")))), "\n").alias("source"))  # one line a nation
    files = rows.select(F.concat(F.lit("pkg/m"), F.col("s_suppkey").cast("string"), F.lit(".py")).alias("file"), body.alias("source"))
    return files.unionByName(hub.select(F.lit("pkg/hub.py").alias("file"), "source"))


@query(
    f"""
    with recursive {FILES}, r as (select a, b from e union select r.a, e.b from r join e on r.b = e.a),
    c as (select x.a as node, least(x.a, min(x.b)) as component from r x join r y on x.a = y.b and x.b = y.a group by 1)
    select e.a, e.b, p.component from e join c p on p.node = e.a join c q on q.node = e.b and q.component = p.component
    """
)
def import_cycles(spark, sf_dir):
    """[GR-08] imports between files that lie on a cycle: rings of suppliers, and chains that a hub closes."""
    files = _modules(spark, sf_dir)
    return pycode.import_cycles(pycode.facts(files), files)


@query(f"""with {FILES} select value from (select 'graph TD' as value union all select '    "' || a || '" --> "' || b || '"' from e)""")
def import_diagram(spark, sf_dir):
    """[GR-09]"""
    files = _modules(spark, sf_dir)
    return pycode.diagram_lines(pycode.file_imports(pycode.facts(files), files))


@query("select p_partkey, p_brand || '-x' as term, case when p_size > 25 then 'ready' else 'unknown' end as slug from part")
def slugs(spark, sf_dir):
    """[FN-18, FN-13]"""
    p = V.table(spark, sf_dir, "part")
    slug = T.status_slug(F.when(F.col("p_size") > 25, " Ready!").otherwise(" ?? "))
    return p.select("p_partkey", F.concat("p_brand", F.lit("-x")).alias("term"), slug.alias("slug"))
