"""Aggregations, picks per key, set operations, deduplication, upserts and enrichment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee import constants as K
from marquee.functions import text
from marquee.operators import aggregates, dedupe, enrich, festival, filters, joins, quality, selection, taxonomy, upsert
from marquee.operators.normalize import to_event
from marquee.operators.similar import similar_pairs
from marquee.plans import inputs as I
from marquee.plans import queries_event as E
from marquee.plans.catalog import Tables, computed, dedupe_key, dice, event_id, norm, query, select_list
from marquee.plans.queries_source import flat
from marquee.session import scratch_path
from marquee.sources import dimensions, keyed
from marquee.streaming.ingest import ingest

C = F.col

# --- groups of copies -------------------------------------------------------------------------------------

DOC_ACTIVE = (
    f"d as (select *, {dedupe_key('title', 'date_start')} as key, {I.PRIORITY} as prio, {I.DOC_FILLED} as filled "
    f"from ({I.DOC_SQL}) where status is distinct from 'duplicate'), "
    "r as (select *, row_number() over (partition by key order by prio desc, filled desc, ord) as rn from d)"
)


def first_of(c: str, filled: str | None = None) -> str:
    return f"(arg_min({c}, rn) filter (where {filled or c + ' is not null'})) as {c}"


SURVIVOR_SQL = (
    f"with {DOC_ACTIVE}, g as (select key, count(*) as group_size, arg_min(event_id, rn) as event_id, arg_min(source, rn) as source, "
    + ", ".join(first_of(c) for c in ("interested", "going", "ticket_url", "price", "hour_start", "genre_raw", "facebook_id"))
    + ", " + ", ".join(first_of(c, f"len({c}) > 0") for c in ("artists", "organizers"))
    + ", arg_min(aggregator_id, rn) filter (where rn = 1) as aggregator_id from r group by key) "
    "select event_id, source, group_size, interested, going, ticket_url, price, hour_start, genre_raw, facebook_id, "
    "coalesce(array_to_string(artists, '|'), '') as artists, coalesce(array_to_string(organizers, '|'), '') as organizers, "
    "aggregator_id from g"
)
SURVIVOR_COLUMNS = [
    "event_id", "source", "group_size", "interested", "going", "ticket_url", "price", "hour_start", "genre_raw",
    "facebook_id", "artists", "organizers", "aggregator_id",
]


@query("ddp1_exact_groups", SURVIVOR_SQL)
def _(t: Tables):
    return flat(dedupe.exact_pass(I.doc_events(t)).select(*SURVIVOR_COLUMNS))


@query("ddp2_source_priority", f"with d as ({I.DOC_SQL}) select event_id, {I.PRIORITY}::int as prio from d")
def _(t: Tables):
    return I.doc_events(t).select("event_id", dedupe.source_priority(C("source")).alias("prio"))


# the duplicates of `show_events`: exact groups, their similar pairs, and the pairs gone through one by one per
# date, the removed rows carried along in a list
SHOW_ACTIVE = (
    f"w as (select *, {norm('title')} as a, {I.PRIORITY} as prio, {I.SHOW_FILLED} as filled from ({I.SHOW_SQL}) where status <> 'duplicate'), "
    "n as (select *, row_number() over (partition by a, date_start order by prio desc, filled desc, ord) as rn, min(ord) over (partition by a, date_start) as place from w), "
    "u as (select * from n where rn = 1), "
    "q as (select x.date_start, x.place as i, y.place as j, x.a as a, y.a as b, case when x.prio >= y.prio then y.event_id else x.event_id end as loser, "
    "case when x.prio >= y.prio then x.event_id else y.event_id end as winner from u x join u y on x.date_start = y.date_start and x.place < y.place) "
)


@query("ddp3_similar_pairs", f"with {SHOW_ACTIVE} select i, j, round({dice('a', 'b')}, 6) as sim from q where {dice('a', 'b')} >= 0.85")
def _(t: Tables):
    nodes = I.show_events(t).where(filters.is_active()).select(
        "ord", "date_start", text.normalize_text(C("title")).alias("text")
    )
    once = nodes.groupBy("date_start", "text").agg(F.min("ord").alias("ord"))
    pairs = similar_pairs(once, "ord", "ord", "date_start", "text")
    return pairs.select("i", "j", F.round("sim", 6).alias("sim"))


@query(
    "join5_same_block_theta",
    "with n as (select c_custkey, c_custkey - c_custkey % 30 as block, lower(c_mktsegment) || ' evening with act number ' || ((c_custkey * 7919) % 1000003) as a from customer), "
    "q as (select x.c_custkey as i, y.c_custkey as j, x.a as a, y.a as b from n x join n y on x.block = y.block and x.c_custkey < y.c_custkey "
    "and length(x.a) - 1 >= 0.739 * (length(y.a) - 1) and length(y.a) - 1 >= 0.739 * (length(x.a) - 1)), "
    f"s as (select i, j, {dice('a', 'b')} as sim from q) select i, j, round(sim, 6) as sim from s where sim >= 0.85",
)
def _(t: Tables):
    name = F.concat(F.lower("c_mktsegment"), F.lit(" evening with act number "), (C("c_custkey") * 7919) % 1000003)
    nodes = t("customer").select("c_custkey", (C("c_custkey") - C("c_custkey") % 30).alias("block"), name.alias("text"))
    pairs = similar_pairs(nodes, "c_custkey", "c_custkey", "block", "text")
    return pairs.select("i", "j", F.round("sim", 6).alias("sim"))


GREEDY_SQL = (
    f"with recursive {SHOW_ACTIVE}, "
    f"p as (select *, row_number() over (partition by date_start order by i, j) as k from q where {dice('a', 'b')} >= 0.85), "
    "r as (select distinct date_start, 0::bigint as k, []::varchar[] as lost, false as fired, null::varchar as loser, null::varchar as winner, null::bigint as i, null::bigint as j from p union all "
    "select r.date_start, p.k, case when list_contains(r.lost, p.loser) or list_contains(r.lost, p.winner) then r.lost else list_append(r.lost, p.loser) end, "
    "not (list_contains(r.lost, p.loser) or list_contains(r.lost, p.winner)), p.loser, p.winner, p.i, p.j from r join p on p.date_start = r.date_start and p.k = r.k + 1), "
    "f as (select loser, winner, i, j from r where fired), "
    "c as (select loser, winner as root, i, j, 0 as depth from f union all select c.loser, f.winner, c.i, c.j, c.depth + 1 from c join f on f.loser = c.root), "
    "k as (select loser, arg_max(root, depth) as root, any_value(i) as i, any_value(j) as j from c group by loser) "
)


@query("ddp4_greedy_resolution", GREEDY_SQL + "select * from k")
def _(t: Tables):
    kills = dedupe.fuzzy_kills(dedupe.exact_pass(I.show_events(t)))
    return kills.select("loser", "root", C("at.i").alias("i"), C("at.j").alias("j"))


MERGED = {"price": "price is not null", "going": "going is not null", "artists": "len(artists) > 0"}


@query(
    "ddp5_marked_duplicates",
    GREEDY_SQL
    + ", g as (select a, date_start, arg_min(event_id, rn) as event_id, " + ", ".join(f"arg_min({c}, rn) filter (where {ok}) as {c}" for c, ok in MERGED.items()) + " from n group by a, date_start), "
    "m as (select k.root, " + ", ".join(f"arg_min(g.{c}, (i, j)) filter (where g.{c} is not null) as {c}" for c in MERGED) + " from k join g on g.event_id = k.loser group by k.root), "
    "alive as (select g.event_id, " + ", ".join(f"coalesce(g.{c}, m.{c}) as {c}" for c in MERGED) + " from g left join m on m.root = g.event_id where g.event_id not in (select loser from k)) "
    "select x.event_id, case when alive.event_id is null then 'duplicate' else x.status end as status, x.source, x.title, x.date_start, x.aggregator_id, "
    "case when alive.event_id is null then x.price else alive.price end as price, case when alive.event_id is null then x.going else alive.going end as going, "
    "coalesce(array_to_string(case when alive.event_id is null then x.artists else alive.artists end, '|'), '') as artists, null::varchar as venue, '' as organizers, '' as support_acts, null::varchar as description "
    f"from ({I.SHOW_SQL}) x left join alive on alive.event_id = x.event_id",
)
def _(t: Tables):
    done, _links = dedupe.deduplicate(I.show_events(t))
    return flat(done.select(
        "event_id", "status", "source", "title", "date_start", "aggregator_id", "price", "going", "artists", "venue", "organizers", "support_acts", "description"
    ))


@query(
    "ddp6_merged_ids",
    GREEDY_SQL
    + ", s as (select a, date_start, event_id as survivor from u), "
    "e as (select a, date_start, rn, unnest(range(1, 3)) as pos, unnest(string_split(aggregator_id, ', ')) as id from n where aggregator_id is not null), "
    "l as (select coalesce(k.root, s.survivor) as event_id, e.id, coalesce(k.i, -1) as i, coalesce(k.j, -1) as j from e join s using (a, date_start) left join k on k.loser = s.survivor) "
    "select event_id, id, min((i, j))[1] as i, min((i, j))[2] as j from l group by event_id, id",
)
def _(t: Tables):
    _done, links = dedupe.deduplicate(I.show_events(t))
    return links.select("event_id", "id", C("place.match.i").alias("i"), C("place.match.j").alias("j"))


# --- aggregations --------------------------------------------------------------------------------------------


@query("agg1_group_sizes", f"with d as (select {dedupe_key('text', 'lang')} as key from documents) select key, count(*) as n from d group by key")
def _(t: Tables):
    keyed = t.heavy("documents").select(text.dedupe_key(C("text"), C("lang")).alias("key"))
    return keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


SORT_KEYS = "partition by o_custkey order by o_orderkey"


@query(
    "agg2_survivor_fold",
    "with o as (select *, case when o_orderkey % 3 = 0 then o_orderstatus end as a, case when o_orderkey % 4 = 1 then o_totalprice end as b, "
    "case when o_orderkey % 5 = 2 then [o_orderpriority] else []::varchar[] end as l from orders) "
    "select o_custkey, arg_min(a, o_orderkey) filter (where a is not null) as a, arg_min(b, o_orderkey) filter (where b is not null) as b, "
    "coalesce((arg_min(l, o_orderkey) filter (where len(l) > 0))[1], '') as l from o group by o_custkey",
)
def _(t: Tables):
    rows = t("orders").select(
        "o_custkey", "o_orderkey",
        F.when(C("o_orderkey") % 3 == 0, C("o_orderstatus")).alias("a"),
        F.when(C("o_orderkey") % 4 == 1, C("o_totalprice")).alias("b"),
        F.when(C("o_orderkey") % 5 == 2, F.array("o_orderpriority")).otherwise(F.array().cast("array<string>")).alias("l"),
    )
    at = C("o_orderkey")
    folded = rows.groupBy("o_custkey").agg(
        selection.first_filled(C("a"), at).alias("a"), selection.first_filled(C("b"), at).alias("b"),
        selection.first_nonempty(C("l"), at).alias("l"),
    )
    return folded.withColumn("l", F.coalesce(F.array_join("l", ","), F.lit("")))


@query("agg3_filled_fields", f"with d as ({I.DOC_SQL}) select event_id, ({I.DOC_FILLED})::int as n from d")
def _(t: Tables):
    rows = I.doc_events(t)
    return rows.select("event_id", aggregates.filled_count(rows, [c for c in rows.columns if c != "ord"]).alias("n"))


@query(
    "agg4_days_per_node",
    "select user_id, min(day(ts))::int as first_day, case when max(day(ts)) > min(day(ts)) then max(day(ts))::int end as last_day, "
    "arg_min(event_type, event_id) as event_type, count(distinct day(ts))::int as n_days from events group by user_id",
)
def _(t: Tables):
    rows = t("events").select("user_id", F.day("ts").alias("day"), "event_type", "event_id")
    days = aggregates.days_per_node(rows, "user_id", "day", "event_type", "event_id")
    return days.withColumn("n_days", F.size("days")).drop("days")


EURO = "replace(regexp_replace(printf('%.2f', {0}), '\\.00$', ''), '.', ',')"


@query(
    "agg5_price_range",
    "with m as (select c_nationkey, c_mktsegment, min(case when c_acctbal > 0 then c_acctbal end) as lo, max(case when c_acctbal > 0 then c_acctbal end) as hi from customer group by all) "
    f"select c_nationkey, c_mktsegment, case when lo = hi then '€' || {EURO.format('lo')} else '€' || {EURO.format('lo')} || '-' || {EURO.format('hi')} end as price from m",
)
def _(t: Tables):
    return aggregates.price_range_per(t("customer"), ["c_nationkey", "c_mktsegment"], "c_acctbal")


@query(
    "agg6_fill_profile",
    f"with d as ({I.DOC_SQL}) select source, count(*) as n_rows, count(price) as n_price, count(hour_start) as n_hour_start, "
    "count(*) filter (where len(artists) > 0) as n_artists from d group by rollup (source)",
)
def _(t: Tables):
    return aggregates.fill_profile(I.doc_events(t), "source", ["price", "hour_start", "artists"])


@query(
    "val3_profile_over_runs",
    "select o_orderpriority, count(*) as n_rows, count(*) as n_o_custkey, count(case when o_orderkey % 7 <> 3 then 1 end) as n_clerk, "
    "min(o_totalprice) as low_o_totalprice, max(o_totalprice) as high_o_totalprice, true as custkeys_near, true as clerks_near, true as median_near from orders group by 1",
)
def _(t: Tables):
    rows = t("orders").withColumn("clerk", F.when(C("o_orderkey") % 7 != 3, F.concat(F.lit("k"), C("o_custkey") % 40, F.lit("/"), C("o_orderkey") % 9)))
    path = scratch_path(t.spark, "profiles")
    for run in (0, 1, 2, 1):  # the second run comes twice
        part = rows.where(C("o_orderkey") % 3 == run)
        quality.store_profile(quality.profile_sketches(part, "o_orderpriority", ["o_custkey", "clerk"], ["o_totalprice"]), path, f"r{run}")
    report = quality.profile_report(quality.merged_sketches(t.spark.read.parquet(path), "o_orderpriority"))
    median = report.select("o_orderpriority", "p50_o_totalprice")
    below = F.avg((C("o_totalprice") < C("p50_o_totalprice")).cast("int"))
    upto = F.avg((C("o_totalprice") <= C("p50_o_totalprice")).cast("int"))
    exact = rows.join(F.broadcast(median), "o_orderpriority").groupBy("o_orderpriority").agg(  # a handful of priorities
        F.countDistinct("o_custkey").alias("custkeys"), F.countDistinct("clerk").alias("clerks"), below.alias("below"), upto.alias("upto")
    )
    near = lambda guess, truth: F.abs(C(guess) - C(truth)) <= 0.04 * C(truth) + 1
    return report.join(exact, "o_orderpriority").select(
        "o_orderpriority", "n_rows", "n_o_custkey", "n_clerk", "low_o_totalprice", "high_o_totalprice",
        near("distinct_o_custkey", "custkeys").alias("custkeys_near"), near("distinct_clerk", "clerks").alias("clerks_near"),
        ((C("below") <= 0.52) & (C("upto") >= 0.48)).alias("median_near"),
    )


@query("agg6_nonzero_counts", "select l_returnflag, count(*) filter (where l_discount <> 0) as n_discount, count(*) filter (where l_tax <> 0) as n_tax from lineitem group by 1")
def _(t: Tables):
    return t("lineitem").groupBy("l_returnflag").agg(
        aggregates.nonzero_count("l_discount").alias("n_discount"), aggregates.nonzero_count("l_tax").alias("n_tax")
    )


@query("agg7_action_counts", f"with {E.OLD_NEW} select action, count(*) as n from (select case when old.k is null then 'added' when new.k is null then 'removed' "
       "when old.p is distinct from new.p then 'updated' else 'same' end as action from old full join new on old.k = new.k) group by action")
def _(t: Tables):
    rows = t("orders").select(C("o_orderkey").alias("k"), C("o_totalprice").alias("p"))
    old = rows.where(C("k") % 3 > 0)
    new = rows.where(C("k") % 3 < 2).withColumn("p", F.when(C("k") % 2 == 0, C("p")).otherwise(C("p") + 1))
    return aggregates.action_counts(upsert.mirror_actions(old, new, "k"))


PULL_SQL = (
    f"with {E.APPROVED_SQL}, e as (select {event_id(chr(39) + 'facebook' + chr(39), 'tt', 'date_start')} as id, coalesce(nullif(venue_id, ''), vid) as venue_id, row_no, "
    "interested, title from n)"
)


@query(
    "agg7_pull_counts",
    PULL_SQL + " select (select count(*) from tab)::hugeint::bigint as rows_in_tab, (select count(*) from tab where lower(trim(approved)) in ('yes', 'true', 'y', 'x', '1', 'approved')) as approved, "
    "(select count(*) from e) as pulled, (select count(venue_id) from e) as venue_resolved, (select count(*) from e where venue_id is null) as venue_unresolved, "
    "(select count(*) from e where id in (select id from e where row_no % 2 = 0)) as updated",
)
def _(t: Tables):
    from marquee.sources import sheets

    tab = E.approved_tab(t)
    events = sheets.approved_events(tab, I.dimensions(t))
    stored = events.where(C("row_no") % 2 == 0).select("event_id").distinct()
    return sheets.pull_counts(tab, events, stored)


# --- genre tables derived from `part` --------------------------------------------------------------------------

# one record per word pair of the part names, one super-genre per second word
GENRE_SQL = (
    "w as (select distinct split_part(p_name, ' ', 1) as a, split_part(p_name, ' ', 2) as b from part), "
    "g as (select 'x' || b as id, upper(b) as label, null::varchar as parent, [b] as keywords, 2 as weight, ['Zydeco ' || b] as aliases from w group by b "
    "union all select 'x' || b || '_' || a, a || ' ' || b, case when a = 'new' then 'nope' else 'x' || b end, case when a = 'old' then []::varchar[] else [a || ' ' || b] end, "
    "case when a = 'hot' then 3 else 1 end, case when a = 'red' then [a] else []::varchar[] end from w), "
    "genre as (select *, row_number() over (order by id)::int as ord from g)"
)
TERMS_SQL = (
    f"term as (select distinct ord, id, weight, term, len(string_split(term, ' ')) as n from (select ord, id, weight, {norm('unnest(keywords || aliases)')} as term from genre) "
    "where term <> '' and not (not contains(term, ' ') and term in ('dub', 'bolt')))"
)


def genres(t: Tables) -> DataFrame:
    words = t("part").select(
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("a"), F.split_part("p_name", F.lit(" "), F.lit(2)).alias("b")
    ).distinct()
    none = F.array().cast("array<string>")
    tops = words.select("b").distinct().select(
        F.concat(F.lit("x"), "b").alias("id"), F.upper("b").alias("label"), F.lit(None).cast("string").alias("parent"),
        F.array("b").alias("keywords"), F.lit(2).alias("weight"), F.array(F.concat(F.lit("Zydeco "), "b")).alias("aliases"),
    )
    subs = words.select(
        F.concat(F.lit("x"), "b", F.lit("_"), "a").alias("id"), F.concat_ws(" ", "a", "b").alias("label"),
        F.when(C("a") == "new", F.lit("nope")).otherwise(F.concat(F.lit("x"), "b")).alias("parent"),
        F.when(C("a") == "old", none).otherwise(F.array(F.concat_ws(" ", "a", "b"))).alias("keywords"),
        F.when(C("a") == "hot", 3).otherwise(1).alias("weight"), F.when(C("a") == "red", F.array("a")).otherwise(none).alias("aliases"),
    )
    both = tops.unionByName(subs)
    # the id is its own place in the list
    return both.withColumn("ord", C("id"))


STOP = ["dub", "bolt"]


@query(
    "src6_other_registries",
    f"with {GENRE_SQL} select 'genre' as kind, id, (row_number() over (order by id) - 1)::int as ord, len(keywords)::int as n from genre "
    "union all select 'organizer', 'o' || n_nationkey, (row_number() over (order by n_nationkey) - 1)::int, 1 from nation "
    "union all select 'stop word', 'w ' || r_regionkey, null, null from region",
)
def _(t: Tables):
    """The genre, organizer and stop-word files are written and read back."""
    home = scratch_path(t.spark, "registries")

    def one_file(rows: DataFrame, key: str, order: str) -> None:
        """A registry is one small JSON file."""
        records = F.array_sort(F.collect_list(F.struct(order, *[c for c in rows.columns if c != order])))
        rows.agg(F.to_json(F.struct(records.alias(key))).alias("value")).write.text(f"{home}/{key}.json")

    one_file(genres(t).drop("ord"), "genres", "id")
    nation = t("nation").select("n_nationkey", F.concat(F.lit("o"), "n_nationkey").alias("id"), C("n_name").alias("name"), F.array("n_name").alias("aliases"))
    one_file(nation, "organizers", "n_nationkey")
    words = F.collect_list(F.concat(F.lit("  W, "), "r_regionkey")).alias("stopwords")
    t("region").agg(F.to_json(F.struct(words)).alias("value")).write.text(f"{home}/stopwords.json")
    listed = dimensions.read_genres(t.spark, f"{home}/genres.json").select(F.lit("genre").alias("kind"), "id", "ord", F.size("keywords").alias("n"))
    organizers = dimensions.read_organizers(t.spark, f"{home}/organizers.json").select(F.lit("organizer").alias("kind"), "id", "ord", F.size("aliases").alias("n"))
    stop = dimensions.read_stopwords(t.spark, f"{home}/stopwords.json").select(
        F.lit("stop word").alias("kind"), C("word").alias("id"), F.lit(None).cast("int").alias("ord"), F.lit(None).cast("int").alias("n")
    )
    return listed.unionByName(organizers).unionByName(stop)



def terms(t: Tables) -> DataFrame:
    return dimensions.term_table(genres(t), STOP)


PART_EVENTS = {
    "ord": "p_partkey",
    "event_id": "concat('x', p_partkey)",
    "title": "case p_partkey % 4 when 0 then concat('Party with ', p_name, ' tonight') when 1 then concat(p_brand, ' evening') when 2 then concat('NEW-', p_name) else 'plain title' end",
    "description": "case when p_partkey % 5 = 0 then concat('and a Red ring, ', p_type) end",
    "genre_raw": "case when p_partkey % 7 = 0 then concat('some ', p_name) when p_partkey % 7 = 1 then 'nothing here' end",
    "artists": "array(concat('DJ ', p_brand))",
    "venue_id": "case when p_partkey % 3 = 0 then concat('v', p_partkey % 90) end",
    "status": "case when p_partkey % 30 = 0 then 'duplicate' end",
    "genre": "case when p_partkey % 30 = 0 then 'old genre' end",
}
PART_SQL = f"e as (select {select_list(PART_EVENTS)} from part)"


def part_events(t: Tables) -> DataFrame:
    return to_event(computed(t("part"), PART_EVENTS), ["ord"], **{c: C(c) for c in PART_EVENTS if c != "ord"})


MATCH_SQL = (
    f"x as (select e.event_id, 0 as pass, {norm('genre_raw')} as t from e union all select e.event_id, 1, "
    + norm("concat_ws(' ', coalesce(title, ''), coalesce(description, ''), '', array_to_string(artists, ' '), '', '', coalesce(array_to_string(v.genres, ' '), ''))")
    + " from e left join venue v on v.id = e.venue_id), "
    "m as (select event_id, arg_min(term.id, (pass, -n, -weight, ord)) as gid from x join term on contains(' ' || t || ' ', ' ' || term || ' ') group by event_id), "
    f"fb as (select name, arg_min(id, ord) as fid from (select ord, id, {norm('unnest([label] || aliases)')} as name from genre) group by name), "
    f"best as (select e.*, coalesce(m.gid, fb.fid) as gid from e left join m on m.event_id = e.event_id left join venue v on v.id = e.venue_id left join fb on fb.name = {norm('v.genres[1]')}), "
    "lab as (select g.id, case when g.parent is null then g.label else coalesce(p.label, g.parent) end as genre, case when g.parent is not null then g.label end as subgenre "
    "from genre g left join genre p on p.id = g.parent)"
)
GENRE_TERMS_SQL = TERMS_SQL.replace("('dub', 'bolt')", "(" + ", ".join(f"'{w}'" for w in K.GENRE_STOPWORDS) + ")")
FULL_GENRE_SQL = f"with {I.WITH_VENUES}, {GENRE_SQL}, {GENRE_TERMS_SQL}, {PART_SQL}, {MATCH_SQL} "


@query("enr2_genre", FULL_GENRE_SQL + "select event_id, lab.genre, lab.subgenre from best left join lab on lab.id = best.gid")
def _(t: Tables):
    found = enrich.with_genre(part_events(t), genres(t), I.dimensions(t))
    return found.select("event_id", "genre", "subgenre")


@query("enr3_genre_rollup", f"with {GENRE_SQL} select g.id as genre_id, case when g.parent is null then g.label else coalesce(p.label, g.parent) end as genre, "
       "case when g.parent is not null then g.label end as subgenre from genre g left join genre p on p.id = g.parent")
def _(t: Tables):
    return dimensions.genre_labels(genres(t))


@query("enr8_active_only", FULL_GENRE_SQL + "select event_id, case when status = 'duplicate' then best.genre else lab.genre end as genre, "
       "case when status is distinct from 'duplicate' then lab.subgenre end as subgenre from best left join lab on lab.id = best.gid")
def _(t: Tables):
    dims, g = I.dimensions(t), genres(t)
    done = enrich.on_active(part_events(t), lambda d: enrich.with_genre(d, g, dims), ["genre", "subgenre"])
    return done.select("event_id", "genre", "subgenre")


@query("val4_genre_coverage", FULL_GENRE_SQL + "select count(*) as n_rows, count(lab.genre) as with_genre, round(100.0 * count(lab.genre) / count(*))::bigint as pct_genre, "
       "count(lab.subgenre) as with_subgenre, round(100.0 * count(lab.subgenre) / count(*))::bigint as pct_subgenre from best left join lab on lab.id = best.gid "
       "where status is distinct from 'duplicate'")
def _(t: Tables):
    return quality.genre_coverage(part_events(t), genres(t), I.dimensions(t))


@query("flt9_keyword_gate", f"with {GENRE_SQL}, {TERMS_SQL}, {PART_SQL} select event_id from e where exists (select 1 from term where "
       f"contains(' ' || {norm('title || chr(32) || coalesce(description, chr(32))')} || ' ', ' ' || term || ' '))")
def _(t: Tables):
    content = F.concat_ws(" ", "title", "description")
    return enrich.mentions_genre(part_events(t), "event_id", content, terms(t)).select("event_id")


@query(
    "win2_best_term",
    f"with {GENRE_SQL}, {TERMS_SQL}, x as (select p_partkey, {norm('concat(p_name, chr(32), p_type, chr(32), p_name)')} as t from part) "
    "select p_partkey, arg_min(term.id, (-n, -weight, ord)) as genre_id from x join term on contains(' ' || t || ' ', ' ' || term || ' ') group by p_partkey",
)
def _(t: Tables):
    content = text.normalize_text(F.concat_ws(" ", "p_name", "p_type", "p_name"))
    texts = t.heavy("part").select("p_partkey", F.lit(0).alias("pass"), content.alias("text"))
    return enrich.best_genre(texts, "p_partkey", terms(t))


DOC_TERMS = ["the of", "the", "la", "der", "thand", "and the are", "eron", "is esndha reedes"]


@query(
    "enr2_terms_in_documents",
    "with term as (select unnest([" + ", ".join(f"'{w}'" for w in DOC_TERMS) + "]) as term), "
    f"x as (select doc_id, {norm('text')} as t from documents) "
    "select term, count(*) as n_docs from x join term on contains(' ' || t || ' ', ' ' || term || ' ') group by term",
)
def _(t: Tables):
    listed = t.spark.createDataFrame([(i, f"t{i}", w) for i, w in enumerate(DOC_TERMS)], "ord int, id string, word string")
    none = F.array().cast("array<string>")
    records = listed.select("ord", "id", F.lit(1).alias("weight"), F.array("word").alias("keywords"), none.alias("aliases"))
    table = dimensions.term_table(records)
    n = max(len(w.split()) for w in DOC_TERMS)
    shaped = t.heavy("documents").select("doc_id", enrich.phrases(text.normalize_text(C("text")), n, enrich.first_words(table)).alias("phrases"))
    hits = enrich.term_hits(shaped, "doc_id", table, n)
    return hits.select("term", "doc_id").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n_docs"))


@query(
    "agg8_subgenre_counts",
    f"with {GENRE_SQL} select parent, count(*) as n_subs, sum(len(keywords) + len(aliases))::bigint as n_terms from genre where parent is not null group by parent",
)
def _(t: Tables):
    return aggregates.subgenre_counts(genres(t))


# nested raw lists in the layout the taxonomy is built from
RAW_GENRES = {
    "tops": ["tec", "hou", "jam"],
    "sql": "top as (select unnest(['tec', 'hou', 'jam']) as id, unnest([0, 1, 2]) as ord), "
    "ent as (select case p_size % 3 when 0 then 'tec' when 1 then 'hou' else 'jam' end as super, p_size % 3 as s_ord, p_partkey as pos, "
    "case (p_partkey % 64) // 8 % 3 when 0 then 'tec' when 1 then 'hou' else 'jam' end || lpad(cast(p_partkey % 64 as varchar), 2, '0') as code from part)",
}


def raw_genres(t: Tables) -> DataFrame:
    """part as nested raw lists: per super-genre the entries that name a subgenre by its code."""
    code = F.concat(
        F.element_at(F.array(*[F.lit(x) for x in RAW_GENRES["tops"]]), (F.floor(C("p_partkey") % 64 / 8) % 3 + 1).cast("int")),
        F.lpad((C("p_partkey") % 64).cast("string"), 2, "0"),
    )
    name = F.concat(F.lit("UK "), F.lpad((C("p_partkey") % 64).cast("string"), 2, "0"), F.lit(" BREAKS &amp; HI-NRG (EARLY) / ROCK"))
    entry = F.concat(F.lit("<li><a data-code='"), code, F.lit("'>"), name, F.lit("</a></li>"))
    rows = t("part").select((C("p_size") % 3).alias("ord"), C("p_partkey").alias("pos"), code.alias("code"), entry.alias("entry"))
    first = rows.groupBy("ord", "code").agg(F.min(F.struct("pos", "entry")).alias("e"))
    lists = first.groupBy("ord").agg(F.transform(F.array_sort(F.collect_list("e")), lambda e: e["entry"]).alias("genrelist"))
    tops = F.array(*[F.lit(x) for x in RAW_GENRES["tops"]])
    top = F.array(F.lit("TECHNO"), F.lit("HOUSE &amp; GARAGE"), F.lit("JAMAICAN (MUSIC) / REGGAE"))
    return lists.select(
        F.element_at(tops, C("ord") + 1).alias("id"), "ord", F.element_at(top, C("ord") + 1).alias("name"), "genrelist"
    )


@query("agg9_hybrids", f"with {RAW_GENRES['sql']} select code as id, substr(code, 1, 3) as parent, coalesce(string_agg(super, ',' order by s_ord) filter (where super <> substr(code, 1, 3)), '') as hybrids "
       "from (select distinct code, super, s_ord from ent) group by code")
def _(t: Tables):
    built = taxonomy.build(raw_genres(t)).where(C("parent").isNotNull())
    return built.select("id", "parent", F.array_join("hybrids", ",").alias("hybrids"))


@query(
    "enr9_taxonomy",
    f"with {RAW_GENRES['sql']} select code as id, 'UK ' || substr(code, 4) || ' Breaks & Hi-NRG (Early) / Rock' as label, 'uk ' || substr(code, 4) || ' breaks|hi nrg' as keywords, 3 as weight from (select distinct code from ent) where code not in ('tec02', 'tec08') "
    "union all select 'tec02', 'UK 02 Breaks & Hi-NRG (Early) / Rock', 'freetekno|free tekno|tekno|hardtek', 3 from (select distinct code from ent where code = 'tec02') "
    "union all select 'tec08', 'UK 08 Breaks & Hi-NRG (Early) / Rock', 'uk 08 breaks|hi nrg|hard techno', 3 from (select distinct code from ent where code = 'tec08') "
    "union all select 'tec', 'Techno', 'techno|acid techno|dub techno|psychedelic techno|trance techno', 3 union all select 'hou', 'House & Garage', 'house|garage', 3 "
    "union all select 'jam', 'Jamaican (Music) / Reggae', 'jamaican|reggae', 3",
)
def _(t: Tables):
    built = taxonomy.build(raw_genres(t))
    return built.select("id", "label", F.array_join("keywords", "|").alias("keywords"), "weight")


@query("enr10_taxonomy_checks", f"with {GENRE_SQL}, u as (select id, unnest(keywords || aliases) as term from genre) select 'shared' as kind, term, count(distinct id) as n from u group by term having count(distinct id) > 1 "
       "union all select 'forbidden', term, count(*) from u where term in ('red', 'gizmo') group by term union all select 'no terms', '', count(*) from genre where len(keywords) + len(aliases) = 0")
def _(t: Tables):
    g = genres(t)
    shared = taxonomy.shared_terms(g).select(F.lit("shared").alias("kind"), "term", C("n_records").alias("n"))
    forbidden = taxonomy.forbidden_terms(g, ["red", "gizmo"]).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    empty = taxonomy.records_without_terms(g).agg(F.count(F.lit(1)).alias("n"))
    return shared.unionByName(forbidden.withColumn("kind", F.lit("forbidden"))).unionByName(
        empty.select(F.lit("no terms").alias("kind"), F.lit("").alias("term"), "n")
    )


# --- other enrichers ---------------------------------------------------------------------------------------------

LINE_UP = {
    "event_id": "concat('x', event_id)",
    "title": "concat('Night: Acid ', user_id, ' feat. The ', event_type, ' B2B dj set & ACID ', user_id)",
    "description": "case when event_id % 2 = 0 then concat('Live • Foo ', user_id % 7, ' | +more / tba', chr(10), '× Alpha x Beta') end",
}
CONNECT = r"(?i)\s+(?:feat\.?|b2b|vs\.?|presents?|&|\+|×|x)\s+"
ARTIST_SQL = (
    f"with e as (select {select_list(LINE_UP)} from events), c as (select event_id, title || chr(10) || coalesce(description, '') || chr(10) as t from e), "
    f"p as (select event_id, unnest(regexp_split_to_array(t, '{CONNECT}')) as p, unnest(range(1, 30)) as i from c), "
    r"q as (select event_id, i, unnest(regexp_split_to_array(p, '[•|/\n]+')) as s, unnest(range(1, 30)) as k from p where p is not null), "
    r"s as (select event_id, i, k, regexp_replace(s, '^\s+|\s+$', '', 'g') as s from q where s is not null), "
    "f as (select event_id, lower(s) as low, min((i, k)) as place, arg_min(s, (i, k)) as s from s where length(s) between 2 and 60 and lower(s) not in ("
    + ", ".join(f"'{w}'" for w in K.ARTIST_NOISE)
    + ") and regexp_matches(s, '^[a-zA-Z\\x{00c0}-\\x{00ff}0-9]') group by event_id, lower(s)) "
    "select event_id, string_agg(s, '|' order by place) as artists from f group by event_id"
)


@query("enr1_artists", ARTIST_SQL)
def _(t: Tables):
    rows = computed(t("events"), LINE_UP)
    found = enrich.with_artists(to_event(rows, **{c: C(c) for c in LINE_UP}))
    return flat(found.select("event_id", "artists"))


NOISE = ", ".join(f"'{w}'" for w in K.ARTIST_NOISE)
# names in a text `t`, in order, and those whose lower-case form was not seen before
NAMES_IN = (
    f"list_filter(list_transform(flatten(list_transform(regexp_split_to_array(t, '{CONNECT}'), lambda x: regexp_split_to_array(x, '[•|/\\n]+'))), "
    "lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: length(x) between 2 and 60 and lower(x) not in (" + NOISE + ") "
    "and regexp_matches(x, '^[a-zA-Z\\x{00c0}-\\x{00ff}0-9]'))"
)
FIRST_NAMES = "list_filter(l, lambda x, i: list_position(list_transform(l, lambda y: lower(y)), lower(x)) = i)"


@query(
    "enr1_artists_in_documents",
    f"with c as (select doc_id, text || chr(10) || chr(10) as t from documents), s as (select doc_id, {NAMES_IN} as l from c) "
    "select doc_id, len(list_distinct(list_transform(l, lambda x: lower(x))))::int as n, coalesce(l[1], '') as first from s",
)
def _(t: Tables):
    rows = to_event(t.heavy("documents"), ["doc_id"], title=C("text"))
    found = enrich.with_artists(rows)
    return found.select("doc_id", F.size("artists").alias("n"), F.coalesce(F.get("artists", F.lit(0)), F.lit("")).alias("first"))


@query("enr4_places", E.GEO_SQL)
def _(t: Tables):
    return E.placed(t).select("event_id", "geo_query", "place_from", "latitude", "longitude", "address", "venue_id", "area")


@query("enr5_area", f"with g as (select {select_list(E.GEO_INPUT)} from events) select event_id, {E.AREA_SQL.format('latitude', 'longitude')} as area from g where latitude is not null")
def _(t: Tables):
    rows = E.geo_events(t).where(C("latitude").isNotNull())
    return rows.select("event_id", joins.area_of(C("latitude"), C("longitude")).alias("area"))


@query("enr6_geo_query", f"with g as (select {select_list(E.GEO_INPUT)} from events) select event_id, coalesce(nullif(address, ''), nullif(venue, '')) || ', Gent, Belgium' as q from g")
def _(t: Tables):
    return E.geo_events(t).select("event_id", enrich.geo_query(C("address"), C("venue")).alias("q"))


BACKFILL = {
    "event_id": "event_id",
    "address": "case when event_id % 6 = 0 then ' ' when event_id % 6 < 5 then concat(' Kaai ', user_id, ' ') end",
    "lat": "case when event_id % 4 = 0 then cast(51.01 as double) end",
    "lng": "case when event_id % 4 < 2 then cast(3.71 as double) end",
}
BACKFILL_CACHE = {
    "address": "concat('Kaai ', c_custkey)",
    "lat": "case when c_custkey % 3 = 0 then cast(51.05 as double) when c_custkey % 3 = 1 then cast(50.1 as double) end",
    "lng": "case when c_custkey % 3 < 2 then cast(3.72 as double) end",
}


@query(
    "enr7_position_backfill",
    f"with e as (select {select_list(BACKFILL)} from events), k as (select {select_list(BACKFILL_CACHE)} from customer where c_custkey % 5 > 0), "
    "j as (select e.event_id, e.lat, e.lng, nullif(trim(e.address), '') as key, k.address as hit, k.lat as klat, k.lng as klng from e left join k on k.address = trim(e.address)), "
    "s as (select *, case when lat is not null and lng is not null then 'already' when key is null then 'no address' when klat between 50.95 and 51.15 and klng between 3.55 and 3.90 then 'filled' "
    "when hit is not null then 'unresolved' else 'todo' end as located from j) "
    "select event_id, located, case when located = 'filled' then klat else lat end as lat, case when located = 'filled' then klng else lng end as lng from s",
)
def _(t: Tables):
    rows = computed(t("events"), BACKFILL)
    cache = computed(t("customer").where(C("c_custkey") % 5 > 0), BACKFILL_CACHE)
    return enrich.fill_positions(rows, cache).select("event_id", "located", "lat", "lng")


ADDRESS = {
    "s_suppkey": "s_suppkey",
    "address": "case s_suppkey % 5 when 0 then concat('Tegenover  Kaai ', s_suppkey, 'b, 9000 , Brugge') when 1 then concat('Hal 16, Dok Noord ', s_suppkey) "
    "when 2 then concat('Kerkstraat (naast de kerk), 9000 Gent') when 3 then concat('Plein ', s_suppkey, ' Gent') else 'rechtover WEBA' end",
}


@query(
    "ext16_address_candidates",
    "select s_suppkey, case s_suppkey % 5 when 0 then 'Tegenover Kaai ' || s_suppkey || 'b, 9000, Brugge, Gent, Belgium|Kaai ' || s_suppkey || 'b, 9000, Brugge, Gent, Belgium|Kaai, 9000, Brugge, Gent, Belgium' "
    "when 1 then 'Hal 16, Dok Noord ' || s_suppkey || ', Gent, Belgium|Dok Noord ' || s_suppkey || ', Gent, Belgium|Dok Noord, Gent, Belgium' "
    "when 2 then 'Kerkstraat, 9000 Gent' when 3 then 'Plein ' || s_suppkey || ' Gent' else 'rechtover WEBA, Gent, Belgium|WEBA, Gent, Belgium' end as tries from supplier",
)
def _(t: Tables):
    rows = computed(t("supplier"), ADDRESS)
    return rows.select("s_suppkey", F.array_join(festival.address_candidates(C("address")), "|").alias("tries"))


# --- picks per key -------------------------------------------------------------------------------------------------


@query("win1_group_winner", f"with {DOC_ACTIVE} select key, event_id, prio::int as prio from r where rn = 1")
def _(t: Tables):
    rows = dedupe.ranked(I.doc_events(t).where(filters.is_active())).select(C("_key").alias("key"), "event_id", "_rank")
    won = selection.first_per_key(rows, ["key"], C("_rank"))
    return won.select("key", "event_id", (-C("_rank.prio")).alias("prio"))


@query("win3_first_per_key", "select o_custkey, arg_min(o_orderkey, o_orderkey) as o_orderkey, arg_min(o_orderstatus, o_orderkey) as o_orderstatus from orders group by 1")
def _(t: Tables):
    rows = t("orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return selection.first_per_key(rows, ["o_custkey"], C("o_orderkey"))


@query("win4_last_per_key", "select c_nationkey, arg_max(c_custkey, c_custkey) as c_custkey, arg_max(c_name, c_custkey) as c_name from customer group by 1")
def _(t: Tables):
    rows = t("customer").select("c_nationkey", "c_custkey", "c_name")
    return selection.last_per_key(rows, ["c_nationkey"], C("c_custkey"))


@query("win5_longest_text", "select lang, arg_min(text, (-length(text), doc_id)) as text from documents group by lang")
def _(t: Tables):
    return selection.longest_per_key(t.heavy("documents").select("lang", "text", "doc_id"), ["lang"], "text", C("doc_id"))


IMAGES = {
    "event_id": "user_id",
    "pos": "event_id",
    "url": "concat('https://i.example/styles/', case event_id % 5 when 0 then 'medium' when 1 then 'large' when 2 then 'news_detail_large' when 3 then 'thumb' else 'news_detail_medium' end, "
    "'/activity/image/', event_id % 3, '.jpg?itok=', event_id)",
}


@query(
    "win6_best_image",
    f"with i as (select {select_list(IMAGES)} from events), r as (select *, cast(pos % 3 as varchar) || '.jpg' as image, case pos % 5 when 2 then 0 when 1 then 1 when 4 then 2 when 0 then 3 else 99 end as rank from i) "
    "select event_id, image, arg_min(url, (rank, pos)) as url, min(pos) as pos from r group by event_id, image",
)
def _(t: Tables):
    return festival.best_images(computed(t("events"), IMAGES), "event_id")


@query(
    "win7_latest_filled",
    "with e as (select *, case when event_id % 4 = 0 then value end as v, case when event_id % 3 = 0 then [event_type] else []::varchar[] end as l from events) "
    "select user_id, arg_max(v, event_id) filter (where v is not null) as v, arg_min(event_type, event_id) as first_type, "
    "coalesce((arg_max(l, event_id) filter (where len(l) > 0))[1], '') as l from e group by user_id",
)
def _(t: Tables):
    rows = t("events").select(
        "user_id", "event_id", "event_type", F.when(C("event_id") % 4 == 0, C("value")).alias("v"),
        F.when(C("event_id") % 3 == 0, F.array("event_type")).otherwise(F.array().cast("array<string>")).alias("l"),
    )
    at = C("event_id")
    return rows.groupBy("user_id").agg(
        selection.last_filled(C("v"), at).alias("v"), F.min_by("event_type", "event_id").alias("first_type"),
        F.coalesce(F.array_join(selection.last_nonempty(C("l"), at), ","), F.lit("")).alias("l"),
    )


@query(
    "win8_carried_forward",
    "select event_id, last_value(case when event_id % 7 = 0 then value end ignore nulls) over (partition by event_type order by event_id rows between unbounded preceding and current row) as heading, "
    "row_number() over (partition by event_type order by event_id) as n from events",
)
def _(t: Tables):
    rows = t("events").select("event_id", "event_type", F.when(C("event_id") % 7 == 0, C("value")).alias("v"))
    carried = selection.carried_forward(rows, ["event_type"], "event_id", "v", "heading", width=1000)
    return selection.numbered(carried, ["event_type"], "event_id", "n", width=1000).select("event_id", "heading", "n")


# --- sets ----------------------------------------------------------------------------------------------------------


@query("set1_union_all", "select event_id, 'a' as part, null::bigint as user_id from events union all select event_id, 'b', user_id from events")
def _(t: Tables):
    a = t("events").select("event_id", F.lit("a").alias("part"))
    b = t("events").select("event_id", F.lit("b").alias("part"), "user_id")
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), [a, b])


@query("set2_two_sections", "select event_id, 'program' as section from events where event_type in ('view', 'click') union all select event_id, 'extra' from events where event_id % 2 = 0")
def _(t: Tables):
    e = t("events")
    program = e.where(C("event_type").isin("view", "click")).select("event_id", F.lit("program").alias("section"))
    return program.unionByName(e.where(C("event_id") % 2 == 0).select("event_id", F.lit("extra").alias("section")))


@query("set3_stored_minus_incoming", "select distinct o_custkey from orders where o_custkey not in (select c_custkey from customer where c_nationkey < 12)")
def _(t: Tables):
    stored = t("orders").select("o_custkey").distinct()
    incoming = t("customer").where(C("c_nationkey") < 12).select(C("c_custkey").alias("o_custkey"))
    return joins.unseen(stored, incoming, "o_custkey")


@query("set5_forbidden_words", f"select item_id, list_has_any(string_split({norm('text')}, ' '), ['the', 'thand', 'zzz']) as hit from benchmark")
def _(t: Tables):
    words = F.split(text.normalize_text(C("text")), " ")
    return t("benchmark").select("item_id", F.arrays_overlap(words, F.array(F.lit("the"), F.lit("thand"), F.lit("zzz"))).alias("hit"))


# --- upserts -------------------------------------------------------------------------------------------------------

STORED = {
    "event_id": event_id("'goabase'", "title", "date_start"), "title": "title || ' old'", "date_start": "date_start", "price": "'old price'",
    "room": "'old room'", "description": "null::varchar", "venue": "'old venue'", "support_acts": "['Old act']",
}
FRESH_SQL = (
    f"r as (select *, {event_id(chr(39) + 'goabase' + chr(39), 'title', 'date_start')} as id from ({I.RAW_SQL}) where date_start is not null and date_start <> ''), "
    "o as (select id, title || ' old' as title, 'old price' as price, 'old venue' as venue, case when ord % 4 = 0 then 'old text' end as description from r where ord % 2 = 0), "
    "f as (select id, title, price, venue_name as venue, description from r where ord % 3 > 0)"
)


def stored_and_fresh(t: Tables):
    from marquee.operators import normalize

    rows = normalize.has_date(I.raw_events(t, "goabase"))
    key = text.event_id(F.lit("goabase"), C("title"), C("date_start"))
    stored = to_event(
        rows.where(C("ord") % 2 == 0), event_id=key, title=F.concat("title", F.lit(" old")), date_start=C("date_start"),
        price=F.lit("old price"), venue=F.lit("old venue"), description=F.when(C("ord") % 4 == 0, F.lit("old text")),
        support_acts=F.array(F.lit("Old act")),
    )
    fresh = to_event(
        rows.where(C("ord") % 3 > 0), ["ord"], event_id=key, title=C("title"), date_start=C("date_start"), price=C("price"),
        venue=C("venue_name"), description=C("description"),
        support_acts=F.when(C("ord") % 5 == 0, F.array(F.lit("New act"))).otherwise(F.array().cast("array<string>")),
    )
    return stored, fresh


UPS1_SQL = (
    f"with {FRESH_SQL}, s as (select id, case when ord % 5 = 0 then 'New act' end as act, ord % 2 = 0 as was, ord % 3 > 0 as now from r) "
    "select coalesce(o.id, f.id) as event_id, coalesce(o.title, f.title) as title, coalesce(f.price, o.price) as price, case when o.id is not null then o.venue else f.venue end as venue, "
    "coalesce(f.description, o.description) as description, coalesce(case when s.now then s.act end, case when s.was then 'Old act' end, '') as support_acts "
    "from o full join f on o.id = f.id join s on s.id = coalesce(o.id, f.id)"
)


@query("ups1_merge_events", UPS1_SQL)
def _(t: Tables):
    stored, fresh = stored_and_fresh(t)
    merged = upsert.merge_events(stored, fresh)
    return flat(merged.select("event_id", "title", "price", "venue", "description", "support_acts"))


SHEET = {
    "row_no": "o_orderkey",
    "event_id": "case when o_orderkey % 50 = 0 then '' else concat('k', o_orderkey % 12000) end",
    "title": "concat('old ', o_orderkey)",
    "date_start": "substr(cast(o_orderdate as string), 1, 10)",
    "status": "case when o_orderkey % 5 = 0 then 'gone' else 'pending' end",
    "notes": "concat('note ', o_orderkey)",
    "extra": "o_orderpriority",
}
INCOMING = {
    "ord": "c_custkey",
    # every seventh key comes twice
    "event_id": "case when c_custkey % 100 = 99 then '' when c_custkey % 7 = 0 then concat('k', (c_custkey - 1) * 11) else concat('k', c_custkey * 11) end",
    "title": "c_name",
    "date_start": "'1999-01-01'",
    "status": "'pending'",
    "price": "c_mktsegment",
}
MOVED = "select event_id from (select concat('k', p_partkey) as event_id from part) group by 1"
UPS2_SQL = (
    f"with s as (select {select_list(SHEET)} from orders), n as (select {select_list(INCOMING)} from customer), m as ({MOVED}), "
    "f as (select event_id as k, min(row_no) as row_no from s where event_id <> '' group by 1), "
    "u as (select s.*, f.k as firstkey, n.title as nt, n.date_start as nd, n.price as np, n.event_id as nk, m.event_id as mk from s left join f on f.row_no = s.row_no left join (select event_id, arg_max(title, ord) as title, arg_max(date_start, ord) as date_start, arg_max(price, ord) as price from n group by event_id) n on n.event_id = f.k left join m on m.event_id = f.k) "
    "select row_no, event_id, coalesce(nt, title) as title, coalesce(nd, date_start) as date_start, "
    "case when nk is not null then 'pending' when firstkey is not null and {0} and date_start >= '1998-06-15' then case when mk is not null then 'moved' else 'gone' end else status end as status, "
    "notes, extra, case when nk is not null then np else '' end as price, case when nk is not null then 'updated' when firstkey is not null and {0} and date_start >= '1998-06-15' "
    "and status <> case when mk is not null then 'moved' else 'gone' end then case when mk is not null then 'moved' else 'gone' end else 'kept' end as action, '' as seen_by from u "
    "union all select (select max(row_no) from s) + 1 + ord, event_id, title, date_start, status, '', '', price, 'appended', '' from n where event_id not in (select k from f)"
)


def sheet_and_incoming(t: Tables):
    return computed(t("orders"), SHEET), computed(t("customer"), INCOMING)


OWNED = ["event_id", "title", "date_start", "status", "price"]


@query("ups2_upsert_columns", UPS2_SQL.format("false"))
def _(t: Tables):
    sheet, incoming = sheet_and_incoming(t)
    return upsert.upsert_cells(sheet, incoming, "event_id", owned=OWNED, human=["notes", "seen_by"])


@query("ups3_tombstones", UPS2_SQL.format("true"))
def _(t: Tables):
    sheet, incoming = sheet_and_incoming(t)
    moved = t("part").select(F.concat(F.lit("k"), "p_partkey").alias("event_id")).distinct()
    return upsert.upsert_cells(sheet, incoming, "event_id", as_of="1998-06-15", moved=moved, owned=OWNED, human=["notes", "seen_by"])


@query("ups4_header_evolution", "select o_orderkey as row_no, o_orderstatus as extra, '' as event_id, '' as notes, 43 as n_columns from orders")
def _(t: Tables):
    grown = upsert.with_columns_for(t("orders").select(C("o_orderkey").alias("row_no"), C("o_orderstatus").alias("extra")))
    return grown.select("row_no", "extra", "event_id", "notes", F.lit(len(grown.columns) - 2).alias("n_columns"))


ROUTED_SQL = (
    f"with {E.POINTS_SQL}, x as (select e.event_id, coalesce(lat, 0) = 0 or coalesce(lng, 0) = 0 as failed, d.ord, d.date_start from e join d on d.event_id = e.event_id), "
    "old as (select 'e' || doc_id as event_id, doc_id as row_no, case when doc_id % 2 = 0 then '2024-02-01' else '2020-01-01' end as date_start from documents where doc_id % 4 = 0 union all "
    "select 'z' || doc_id, 1000000 + doc_id, '2024-02-01' from documents where doc_id % 10 = 0) "
    "select tab, action, count(*) as n from (select 'located' as tab, case when x.event_id is not null then 'updated' when old.date_start >= '2024-01-15' then 'gone' else 'kept' end as action "
    "from old left join x on x.event_id = old.event_id and not failed union all select 'located', 'appended' from x where not failed and event_id not in (select event_id from old) "
    "union all select 'failed', case when f.event_id is not null then 'updated' when old.date_start >= '2024-01-15' then case when l.event_id is not null then 'moved' else 'gone' end else 'kept' end "
    "from old left join x f on f.event_id = old.event_id and f.failed left join x l on l.event_id = old.event_id and not l.failed "
    "union all select 'failed', 'appended' from x where failed and event_id not in (select event_id from old)) group by all"
)


@query("ups5_two_tables", ROUTED_SQL)
def _(t: Tables):
    docs = t.heavy("documents")
    old = docs.where(C("doc_id") % 4 == 0).selectExpr(
        "concat('e', doc_id) as event_id", "doc_id as row_no", "case when doc_id % 2 = 0 then '2024-02-01' else '2020-01-01' end as date_start"
    ).unionByName(
        docs.where(C("doc_id") % 10 == 0).selectExpr("concat('z', doc_id) as event_id", "1000000 + doc_id as row_no", "'2024-02-01' as date_start")
    ).withColumn("status", F.lit("pending"))
    located, failed = upsert.route_and_upsert(E.overridden(t), old, old, I.AS_OF)
    both = located.withColumn("tab", F.lit("located")).unionByName(failed.withColumn("tab", F.lit("failed")))
    return both.groupBy("tab", "action").agg(F.count(F.lit(1)).alias("n"))


# the other key is not unique on either side
@query("ups6_upsert_by_other_key", f"with s as (select row_no, 'f' || (row_no - row_no % 3) as facebook_id, title, notes from (select {select_list(SHEET)} from orders)), "
       "n as (select c_custkey as ord, 'f' || case when c_custkey % 4 = 0 then c_custkey * 30 - 30 else c_custkey * 30 end as facebook_id, c_name as title from customer), "
       "f as (select facebook_id, min(row_no) as row_no from s group by 1), l as (select facebook_id, arg_max(title, ord) as title from n group by 1) "
       "select s.row_no, s.facebook_id, coalesce(l.title, s.title) as title, s.notes, case when l.title is not null then 'updated' else 'kept' end as action "
       "from s left join f on f.row_no = s.row_no left join l on l.facebook_id = f.facebook_id union all "
       "select (select max(row_no) from s) + 1 + ord, facebook_id, title, '', 'appended' from n where facebook_id not in (select facebook_id from f)")
def _(t: Tables):
    key = C("row_no") - C("row_no") % 3
    sheet = computed(t("orders"), SHEET).select("row_no", F.concat(F.lit("f"), key).alias("facebook_id"), "title", "notes")
    theirs = F.when(C("c_custkey") % 4 == 0, C("c_custkey") * 30 - 30).otherwise(C("c_custkey") * 30)
    incoming = t("customer").select(C("c_custkey").alias("ord"), F.concat(F.lit("f"), theirs).alias("facebook_id"), C("c_name").alias("title"))
    return upsert.upsert_cells(sheet, incoming, "facebook_id", owned=["facebook_id", "title"], human=["notes"])


@query("ups7_override_sync", f"with d as ({I.DOC_SQL}), o as ({E.OVERRIDE_SQL}) select d.event_id, o.venue, o.genre, "
       "coalesce(not (o.venue is null and o.latitude is null and o.genre is null and o.hide is null and o.approved is null), false) as touched from d left join o on o.event_id = d.event_id")
def _(t: Tables):
    return E.overridden(t).select("event_id", "overrides.venue", "overrides.genre", "touched")


@query(
    "ups8_mirror_sync",
    "select action, count(*) as n, count(distinct id) as ids from (select coalesce(n.id, o.id) as id, case when o.id is null then 'added' when n.id is null then 'removed' when o.name is distinct from n.name or o.bal is distinct from n.bal "
    "then 'updated' else 'same' end as action from (select s_suppkey as id, s_name as name, s_acctbal as bal from supplier where s_suppkey % 5 > 0) o full join "
    "(select s_suppkey as id, s_name as name, case when s_suppkey % 3 = 0 then null else s_acctbal end as bal from supplier where s_suppkey % 7 > 0) n on n.id = o.id) group by action",
)
def _(t: Tables):
    rows = t("supplier").select(C("s_suppkey").alias("id"), C("s_name").alias("name"), C("s_acctbal").alias("bal"))
    local = rows.where(C("id") % 5 > 0)
    sheet = rows.where(C("id") % 7 > 0).withColumn("bal", F.when(C("id") % 3 != 0, C("bal")))
    actions = upsert.mirror_actions(local, sheet)
    removed = actions.join(upsert.mirrored(actions).select("id"), "id", "left_anti")  # what the mirror no longer holds
    kept = actions.join(upsert.mirrored(actions).select("id"), "id")
    return kept.unionByName(removed).groupBy("action").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids"))


@query(
    "ups9_replace_rows",
    "with f as (select o_custkey as k, arg_max(o_totalprice, o_orderkey) as v from orders where o_orderkey % 3 = 0 group by 1) "
    "select c_custkey as k, c_acctbal as v from customer where c_custkey not in (select k from f) union all select k, v from f",
)
def _(t: Tables):
    stored = t("customer").select(C("c_custkey").alias("k"), C("c_acctbal").alias("v"))
    fresh = t("orders").where(C("o_orderkey") % 3 == 0).select(C("o_custkey").alias("k"), C("o_totalprice").alias("v"), "o_orderkey")
    return upsert.replace_rows(stored, fresh, "k", "o_orderkey")


# --- incremental ingest -----------------------------------------------------------------------------------------------


@query("stm1_incremental_ingest", UPS1_SQL)
def _(t: Tables):
    stored, fresh = stored_and_fresh(t)
    home = scratch_path(t.spark, "ingest")
    keyed.change(t.spark, f"{home}/table", "event_id", stored, lambda _, rows: rows, rows_each=5_000)
    fresh.write.parquet(f"{home}/raw")
    # the second run finds nothing new
    for _ in range(2):
        ingest(t.spark, f"{home}/raw", fresh.schema, lambda batch: batch, f"{home}/table", f"{home}/checkpoint", rows_each=5_000)
    rows = keyed.read(t.spark, f"{home}/table", stored.schema)
    return flat(rows.select("event_id", "title", "price", "venue", "description", "support_acts"))
