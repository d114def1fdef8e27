"""Text operators on pages, documents and derived bulletins."""

from pyspark.sql import functions as F

from hazardloom.functions import dates as D
from hazardloom.functions import text as T
from hazardloom.functions.areas import register
from hazardloom.functions.bulletins import signal_areas as signal_rows
from hazardloom.queries import query
from hazardloom.sources.pages import basin_status
from hazardloom.sources.tables import spread, table

FMT = "'%Y-%m-%d %H:%M:%S'"
# The entities that the pages hold.
_UNESCAPE = "replace(replace(replace(replace(replace(replace(replace(replace({}, '&middot;', '·'), '&copy;', '©'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&')"


@query(f"""select page_id, trim(regexp_replace({_UNESCAPE.format("regexp_replace(html, '<[^>]*>', ' ', 'g')")}, '[ \\t\\n\\v\\f\\r\\x{{A0}}]+', ' ', 'g')) as text from pages""")
def html_cell_text(spark, d):
    return table(spark, d, "pages").select("page_id", T.cell_text(F.col("html")).alias("text"))


@query(f"""with a as (select page_id, {_UNESCAPE.format("regexp_replace(regexp_replace(html, '(?i)<br\\s*/?>', chr(10), 'g'), '<[^>]*>', ' ', 'g')")} as t from pages),
b as (select page_id, array_to_string(list_transform(string_split(t, chr(10)), lambda x: trim(regexp_replace(x, '[ \\t\\r\\x{{A0}}]+', ' ', 'g'))), chr(10)) as t from a)
select page_id, regexp_replace(regexp_replace(t, '\\n{{3,}}', chr(10) || chr(10), 'g'), '^\\n+|\\n+$', '', 'g') as text from b""")
def html_block_text(spark, d):
    return table(spark, d, "pages").select("page_id", T.block_text(F.col("html")).alias("text"))


@query("""select page_id, md5(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?s)<script[^>]*>.*?</script>', '', 'g'), '(?s)<style[^>]*>.*?</style>', '', 'g')) as h from pages""")
def html_without_hidden(spark, d):
    return table(spark, d, "pages").select("page_id", F.md5(T.without_hidden(F.col("html"))).alias("h"))


@query("""with l as (select page_id, unnest(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1)) as link, generate_subscripts(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1), 1) as pos from pages)
select page_id, (pos - 1)::int as pos, regexp_replace(replace(link, '\\', '/'), '^[./]+', '') as link from l""")
def html_links(spark, d):
    """List links in order, their paths cleaned."""
    links = F.regexp_extract_all("html", F.lit(r'<li><a href="([^"]*)">([^<]*)</a></li>'), F.lit(1))
    rows = table(spark, d, "pages").select("page_id", F.posexplode(links).alias("pos", "link"))
    return rows.select("page_id", "pos", T.clean_link(F.col("link")).alias("link"))


@query("""with r as (select page_id, regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2) as c from pages)
select page_id, c[1] as first, try_cast(c[2] as double) as level, len(c)::int as cells from r where len(c) >= 3 and c[1] is not null""")
def html_cells_positional(spark, d):
    """Cells of a page decoded by position; too short rows are dropped."""
    cells = F.regexp_extract_all("html", F.lit(r'<li><a href="([^"]*)">([^<]*)</a></li>'), F.lit(2))
    rows = table(spark, d, "pages").select("page_id", cells.alias("c")).where("size(c) >= 3 and c[0] is not null")
    return rows.select("page_id", F.get("c", 0).alias("first"), F.get("c", 1).try_cast("double").alias("level"), F.size("c").alias("cells"))


@query("""with p as (select doc_id, unnest(string_split(text, chr(10))) as p, generate_subscripts(string_split(text, chr(10)), 1) as pos from documents)
select doc_id, (pos - 1)::int as pos, length(trim(p, ' ')) as n from p where length(trim(p, ' ')) >= 40 and not regexp_matches(substr(lower(p), 1, 200), 'there is no .*issued')""")
def advisory_split(spark, d):
    """Paragraphs that are warnings: long enough and not a note that there is none."""
    p = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "p"))
    return p.select("doc_id", "pos", F.length(F.trim("p")).alias("n"), "p").where((F.col("n") >= 40) & ~F.substring(F.lower("p"), 1, 200).rlike("there is no .*issued")).drop("p")


@query("""with l as (select doc_id, string_split(text, chr(10)) as a from documents)
select doc_id, len(a) as n_lines, len(list_filter(a, lambda x, i: i = 1 or x is distinct from a[i - 1])) as n_kept, md5(array_to_string(list_filter(a, lambda x, i: i = 1 or x is distinct from a[i - 1]), chr(10))) as h from l""")
def clean_runs(spark, d):
    """Texts without lines that repeat the line before."""
    a = F.split("text", "\n")
    kept = T.distinct_runs(a)
    return table(spark, d, "documents").select("doc_id", F.size(a).cast("long").alias("n_lines"), F.size(kept).cast("long").alias("n_kept"), F.md5(F.array_join(kept, "\n")).alias("h"))


@query("""with names as (select p_partkey, case p_partkey % 6 when 0 then 'City of ' || p_name when 1 then 'Sto. ' || p_name || ' City' when 2 then 'Mt' || upper(substr(p_name, 1, 1)) || substr(p_name, 2) || ' (cap.)' when 3 then 'Ñuñez ' || p_name when 4 then p_name || ' City of Ő' else p_name || '-City' end as name from part),
a as (select p_partkey, name, lower(regexp_replace(translate(name, 'ñÑŐ', 'nNO'), '([a-z])([A-Z])', '\\1 \\2', 'g')) as s from names),
b as (select p_partkey, name, trim(regexp_replace(trim(regexp_replace(trim(regexp_replace(s, '\\([^)]*\\)', ' ', 'g')), '^city of\\s+', '')), '\\s+city$', '')) as s from a),
c as (select p_partkey, name, trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g')) as s from b)
select p_partkey, name, array_to_string(list_transform(string_split(s, ' '), lambda w: case w when 'gen' then 'general' when 'sto' then 'santo' when 'sta' then 'santa' when 'pres' then 'president' when 'mt' then 'mount' when 'st' then 'saint' else w end), '') as key from c""")
def name_keys(spark, d):
    p, n = table(spark, d, "part"), F.col("p_name")
    big = F.concat(F.upper(F.substring(n, 1, 1)), F.expr("substring(p_name, 2)"))
    k = F.col("p_partkey") % 6
    name = F.when(k == 0, F.concat(F.lit("City of "), n)).when(k == 1, F.concat(F.lit("Sto. "), n, F.lit(" City"))).when(k == 2, F.concat(F.lit("Mt"), big, F.lit(" (cap.)"))).when(k == 3, F.concat(F.lit("Ñuñez "), n)).when(k == 4, F.concat(n, F.lit(" City of Ő"))).otherwise(F.concat(n, F.lit("-City")))
    return p.select("p_partkey", name.alias("name")).withColumn("key", T.name_key(F.col("name")))


@query("""with t as (select event_id, case event_id % 4 when 0 then 'expected within ' || (1 + event_id % 3) || ' to ' || (3 + event_id % 5) || ' hours' when 1 then 'for an hour' when 2 then 'in ' || (event_id % 9) || ' hours or 2 hours' else 'soon' end as t, ts from events)
select event_id, strftime(ts + to_hours((case event_id % 4 when 0 then 3 + event_id % 5 when 1 then 1 when 2 then greatest(event_id % 9, 2) else 3 end)::int), '%Y-%m-%d %H:%M:%S') as expires_at from t""")
def hours_expiry(spark, d):
    k = F.col("event_id")
    s = lambda c: c.cast("string")
    text = F.when(k % 4 == 0, F.concat(F.lit("expected within "), s(k % 3 + 1), F.lit(" to "), s(k % 5 + 3), F.lit(" hours"))).when(k % 4 == 1, "for an hour").when(k % 4 == 2, F.concat(F.lit("in "), s(k % 9), F.lit(" hours or 2 hours"))).otherwise("soon")
    e = table(spark, d, "events").select("event_id", "ts", D.valid_hours(text).alias("h"))
    return e.select("event_id", D.stamp(F.col("ts") + F.make_dt_interval(hours=F.col("h"))).alias("expires_at"))


@query(f"select event_id, strftime(time_bucket(interval 10 minute, ts - interval 10 minute), {FMT}) as slot from events")
def slot_floor(spark, d):
    return table(spark, d, "events").select("event_id", D.stamp(D.slot(F.col("ts"))).alias("slot"))


@query(f"select event_id, strftime(date_trunc('minute', ts), {FMT}) as at from events")
def long_date_parse(spark, d):
    """Times written out in words and read again."""
    text = F.date_format("ts", "d MMMM yyyy - hh:mm a")
    return table(spark, d, "events").select("event_id", D.stamp(D.long_date(text)).alias("at"))


@query(f"select event_id, strftime(date_trunc('minute', ts), {FMT}) as at from events")
def loose_date_parse(spark, d):
    """The same with a comma or ``Sept``, or with the time first."""
    text = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "d MMM, yyyy h:mm a")).otherwise(F.date_format("ts", "h:mm a d MMMM yyyy"))
    return table(spark, d, "events").select("event_id", D.stamp(D.loose_date(text)).alias("at"))


@query(f"""select event_id, case when event_id % 14 between 1 and 12 and event_id % 70 < 60 then strftime(make_timestamp(2024, 1 + event_id % 12, 1 + event_id % 28, ((event_id % 14) % 12 + case when event_id % 3 = 0 then 12 else 0 end), event_id % 70, 0), {FMT}) end as at from events""")
def clock12_parse(spark, d):
    k = F.col("event_id")
    half = F.when(k % 3 == 0, "pm").otherwise("AM")
    return table(spark, d, "events").select("event_id", D.stamp(D.clock12(F.lit(2024), k % 12 + 1, k % 28 + 1, k % 14, k % 70, half)).alias("at"))


@query("""with t as (select event_id, make_date(2024, month(ts)::bigint, day(ts)::bigint) as this, date '2024-01-10' as today from events)
select event_id, strftime(case when date_diff('day', today, this) > 2 then this - interval 12 month else this end, '%Y-%m-%d') as day from t""")
def year_infer(spark, d):
    e = table(spark, d, "events")
    day = D.assumed_year(F.dayofmonth("ts"), F.month("ts"), F.lit("2024-01-10").cast("date"))
    return e.select("event_id", F.date_format(day, "yyyy-MM-dd").alias("day"))


@query("select o_orderkey, strftime(date_trunc('month', o_orderdate) + to_months((o_orderkey % 30 - 15)::int), '%Y-%m') as month from orders")
def month_arithmetic(spark, d):
    moved = F.date_format(F.add_months(F.to_date(F.concat(F.date_format("o_orderdate", "yyyy-MM"), F.lit("-01"))), (F.col("o_orderkey") % 30 - 15).cast("int")), "yyyy-MM")
    return table(spark, d, "orders").select("o_orderkey", moved.alias("month"))


@query("select event_id, user_id, json_extract(props, '$.k')::bigint as k, json_extract(props, '$.none')::bigint is null as absent from events")
def json_fields(spark, d):
    p = F.from_json("props", "struct<k: bigint, none: bigint>")
    return table(spark, d, "events").select("event_id", "user_id", p.alias("p")).select("event_id", "user_id", "p.k", F.col("p.none").isNull().alias("absent"))


def _homes(spark, d):
    """Customers with the names of their nation and region, spread over the tasks that read texts made of them."""
    c, n, r = spread(table(spark, d, "customer").select("c_custkey", "c_nationkey"), "c_custkey"), table(spark, d, "nation"), table(spark, d, "region")
    return c.join(n, F.col("n_nationkey") == F.col("c_nationkey")).join(r, F.col("r_regionkey") == F.col("n_regionkey")).select("c_custkey", "n_name", "n_regionkey", "r_name")


_HOMES = "homes as (select c_custkey, n_name, n_regionkey, r_name from customer join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey)"


@query(f"""with {_HOMES}
select c_custkey, unnest([r_name || ' (' || n_name || ', X and Y)', n_name, 'The northern and central portions of ' || n_name, 'the rest of ' || r_name]) as part, unnest([3, 0, 0, 0]) as towns from homes""")
def top_split(spark, d):
    """A list of areas, split outside brackets by a table function, with the number of towns inside; ``and`` between directions splits nothing."""
    text = F.concat("r_name", F.lit(" ("), "n_name", F.lit(", X and Y), "), "n_name", F.lit(" and The northern and central portions of "), "n_name", F.lit(" and the rest of "), "r_name", F.lit("."))
    rows = _homes(spark, d).select("c_custkey", text.alias("text"))
    return register(spark).sql("select r.c_custkey, s.part, size(s.towns) as towns from {rows} r, lateral split_areas(r.text) s", rows=rows)


def _advisories(spark, d):
    """Sentences with a full stop inside a name, each lead, and one that leads up to nothing."""
    name = F.col("n_name")
    text = F.concat(F.lit("Moderate rain is expected over "), name, F.lit(" (Gen. Mariano Alvarez, Silang) and R"), F.col("n_regionkey").cast("string"), F.lit(" within 2 hours which may persist.\n\nFlooding is being experienced in X"), F.col("c_custkey").cast("string"), F.lit(".\nThunderstorms are MORE LIKELY to develop over the rest of "), name, F.lit(" for the next day.\nRain prevailing over Nowhere."))
    rows = _homes(spark, d).select("c_custkey", text.alias("text"))
    return register(spark).sql("select r.c_custkey, s.* from {rows} r, lateral parse_areas(r.text) s", rows=rows)


@query(f"""with {_HOMES} select c_custkey, unnest([0, 1, 2])::int as pos, unnest(['expected', 'occurring', 'watch']) as status, unnest(['', '', 'MORE']) as likelihood,
  unnest([n_name || ' (Gen. Mariano Alvarez, Silang) and R' || n_regionkey, 'X' || c_custkey, 'the rest of ' || n_name]) as areas from homes""")
def area_sentences(spark, d):
    """Areas named between an expecting phrase and the sentence's time, with their status."""
    return _advisories(spark, d).where("entry = 0").select("c_custkey", F.col("sentence").alias("pos"), "status", "likelihood", "areas")


@query(f"""with {_HOMES} select c_custkey, unnest([0, 0, 1, 2])::int as pos, unnest([n_name, 'R' || n_regionkey, 'X' || c_custkey, n_name]) as name, unnest([false, true, true, true]) as whole, unnest(['Gen. Mariano Alvarez|Silang', '', '', '']) as towns from homes""")
def area_entries(spark, d):
    """Each area of those sentences, with the towns in its brackets."""
    return _advisories(spark, d).select("c_custkey", F.col("sentence").alias("pos"), "name", "whole", F.array_join("towns", "|").alias("towns"))


@query("""select p_partkey, 'Las Piñas – 33° ' || p_name || ' <é & &deg;' as text from part""")
def entity_text(spark, d):
    """Named and numeric entities decoded once: what an entity spells is text."""
    html = F.concat(F.lit("<b>Las Pi&ntilde;as</b>&nbsp;&#8211; 33&deg;\n"), "p_name", F.lit(" &lt;&#xE9; &amp; &amp;deg;"))
    return table(spark, d, "part").select("p_partkey", T.cell_text(html).alias("text"))


@query("""select doc_id, case when regexp_matches(text, '(?i)licen[sc]e|copyright') then 'licence' when regexp_matches(text, '[^ ]+@[^ ]+') then 'mail' when regexp_matches(text, '[0-9]{3}') then 'number' else 'plain' end as kind,
  try_cast(nullif(regexp_extract(text, '([0-9]+)', 1), '') as double) as first_number from documents""")
def rule_classify(spark, d):
    rules = [("(?i)licen[sc]e|copyright", "licence"), ("[^ ]+@[^ ]+", "mail"), ("[0-9]{3}", "number")]
    first = F.nullif(F.regexp_extract("text", "([0-9]+)", 1), F.lit("")).try_cast("double")
    return table(spark, d, "documents").select("doc_id", T.rule_class(F.col("text"), rules, "plain").alias("kind"), first.alias("first_number"))


@query("""with a as (select p_partkey, (p_partkey % 23)::double as h, (p_partkey % 17)::double as m, (p_partkey % 3) / 30.0::double as l from part)
select p_partkey, case when h >= 10 then 'high' when h >= 2 or h + m >= 10 then 'medium' when greatest(h, m, l) >= 0.05 then 'low' else 'none' end as label from a""")
def susceptibility_label(spark, d):
    k = F.col("p_partkey")
    return table(spark, d, "part").select("p_partkey", T.susceptibility((k % 23).cast("double"), (k % 17).cast("double"), (k % 3) / F.lit(30.0)).alias("label"))


@query("""select doc_id, md5(replace(replace(text, 'thousing1', '***'), 'tion anon', '***')) as h, length(replace(replace(text, 'thousing1', '***'), 'tion anon', '***')) as n from documents""")
def scrub_secrets(spark, d):
    """Secrets struck out; ``ation`` is too short to be one."""
    clean = T.scrub(F.col("text"), ["thousing1", "ation", "tion anon"])
    return table(spark, d, "documents").select("doc_id", F.md5(clean).alias("h"), F.length(clean).alias("n"))


@query("""select o_orderkey, try_cast(substr(o_orderpriority, 1, 1) as int) as urgency, case when regexp_matches(o_orderstatus, '^-?[0-9]+(\\.[0-9]+)?$') then 1.0::double end as number from orders where try_cast(substr(o_orderpriority, 1, 1) as int) <= 2""")
def null_tolerant_filter(spark, d):
    """Rows whose text is a number in range; what does not parse is dropped."""
    o = table(spark, d, "orders").withColumn("urgency", F.substring("o_orderpriority", 1, 1).try_cast("int"))
    return o.where("urgency <= 2").select("o_orderkey", "urgency", T.number(F.col("o_orderstatus")).alias("number"))


@query("""select conv_id, string_agg(role, ',' order by turn) as roles, count(*) as turns, max(case when turn = 0 then length(text) end) as first_length from conversations group by conv_id""")
def nested_turns(spark, d):
    """Nested records built and taken apart again."""
    c = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.length("text").alias("n")))).alias("t"))
    first = F.get(F.filter("t", lambda x: x["turn"] == 0), 0)
    return c.select("conv_id", F.array_join(F.col("t.role"), ",").alias("roles"), F.size("t").cast("long").alias("turns"), first["n"].alias("first_length"))


@query(f"""with {_HOMES}, n as (select c_custkey as id, n_name as p from homes)
select id, 3 as signal, 'The northern and extreme central portions of ' || p as area, 'portion' as kind, p as province, null as within from n
union all select id, 3, t, 'city', p, 'The northern and extreme central portions of ' || p from n, (select unnest(['Gen. ' || 'Town', 'Old Place', 'San Isidro']) as t)
union all select id, 3, 'Babuyan Islands', 'place', 'Babuyan Islands', null from n
union all select id, 1, 'the rest of mainland ' || p, 'portion', p, null from n
union all select id, 1, 'Some ' || p, 'place', 'Some ' || p, null from n""")
def signal_areas(spark, d):
    """Areas of wind signals in texts made of each customer's nation: directions with ``and``, names with full stops, island groups."""
    text = F.format_string(
        "Wind Signal No. 3\nLuzon: The northern and extreme central portions of %s (Gen. Town, Old Place; and San Isidro), Babuyan\nIslands\nWind threat: gales over Elsewhere\nTCWS #1\nVISAYAS\nthe rest of mainland %s and Some %s\nBeaufort 6, Nowhere",
        "n_name", "n_name", "n_name",
    )
    rows = _homes(spark, d).select(F.col("c_custkey").alias("id"), text.alias("text"))
    return signal_rows(rows, "id", "text").select("id", "signal", "area", "kind", "province", "within")


@query("""select n_nationkey, n_name || ' Sub-basin' as sub_basin, case when n_nationkey % 2 = 0 then 'Non-flood & calm' else 'Alert' end as status from nation where n_nationkey % 3 != 0""")
def basin_statuses(spark, d):
    """Status tables of river basins, a page per nation; rows that name no sub-basin are none."""
    kind = F.when(F.col("n_nationkey") % 3 == 0, "").otherwise(" Sub-basin")
    status = F.when(F.col("n_nationkey") % 2 == 0, "Non-flood &amp;  calm").otherwise("Alert")
    page = F.concat(F.lit("<table><tr> <td>"), "n_name", kind, F.lit('</td> <td class="s"><a href="#">'), status, F.lit("</a></td></tr><tr><td>x</td></tr></table>"))
    rows = table(spark, d, "nation").select("n_nationkey", F.explode(basin_status(page)).alias("b"))
    return rows.select("n_nationkey", "b.*")


def _bulletins(spark, d):
    """A bulletin for each customer: titles with or without a class, every way to tell the next issue, and headlines, centres and outlooks of each status."""
    s, k = lambda c: c.cast("string"), F.col("c_custkey")
    pick = lambda at, *texts: F.get(F.array(*[F.lit(t) if isinstance(t, str) else t for t in texts]), at.cast("int"))
    c = spread(table(spark, d, "customer").select("c_custkey", "c_nationkey"), "c_custkey").join(table(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    category, day = pick(k % 5, "Super Typhoon", "Severe Tropical Storm", "Tropical Storm", "Tropical Depression", "Typhoon"), F.make_date(F.lit(2026), (k % 12 + 1).cast("int"), (k % 28 + 1).cast("int"))
    name = F.concat(F.lit("X"), s(k))
    title = F.when(k % 11 == 0, F.lit("A bulletin")).otherwise(F.concat(F.when(k % 2 == 0, F.upper(category)).otherwise(category), F.lit(" “"), name, F.lit("”")))
    issued = F.concat(F.lit("Issued at "), F.lpad(s(k % 12 + 1), 2, "0"), F.lit(":05 "), pick(k % 3, "am,", "p.m.", "PM"), F.lit(" "), F.date_format(day, "d MMMM yyyy"))
    until = F.concat(F.lit("(Valid for broadcast until the next advisory to be issued at 5:30 "), pick(k % 4, "PM today", "A.M. , tomorrow", "PM tonight", F.concat(F.lit("AM "), F.date_format(F.date_add(day, 9), "d MMM yyyy"))), F.lit(")"))
    head = pick(k % 7, F.concat(name, F.lit(" IS ABOUT TO EXIT THE AREA.")), F.concat(name, F.lit(" HAS EXITED THE AREA OF RESPONSIBILITY.")), "Not in capitals at all", "TOO SHORT", F.concat(name, F.lit(" MAINTAINS ITS STRENGTH.")), F.concat(name, F.lit(" LEFT AND IS LIKELY TO RE-ENTER IT.")), "HAZARDS AFFECTING LAND AREAS")
    beyond = F.when(k % 2 == 0, " (OUTSIDE  PAR)").otherwise("")
    center = F.when(k % 3 == 0, F.concat(F.lit("The center of the eye of "), category, F.lit(" "), name, F.lit(" at 100 km ("), s(k % 30), F.lit(". °N, 1"), s(k % 10 + 20), F.lit(".5 ° E )"), beyond))
    outlook = F.when(k % 4 == 0, F.concat(name, F.lit(" is forecast to enter the area."))).otherwise(F.concat(name, F.lit(" moves on.")))
    winds = F.concat(F.lit("Maximum sustained winds of "), s(k % 200), F.lit(" km/h near the center and gustiness of up to "), s(k % 250), F.lit(" km/h"))
    forecast = F.concat(F.date_format(day, "MMM d, yyyy"), F.lit(" 08:00 PM - 925 km East (OUTSIDE PAR)\n\n"), F.date_format(F.date_add(day, 1), "MMM d, yyyy"), F.lit(" 08:00 AM – near "), "n_name", F.lit("\nlater"))
    parts = [
        title, "", issued, "", until, "", head, "HAZARDS AFFECTING COASTAL WATERS  ", F.concat(F.lit("Seas off "), F.col("n_name")), "TRACK AND INTENSITY OUTLOOK", outlook, "\nLocation of Eye/center\n", F.coalesce(center, F.lit("")),
        "\nMovement\n\nMoving West at 10 km/h\nStrength", winds, "Forecast Position", forecast, "Wind Signal\n\nTCWS No. 1\nNowhere\nConsidering these developments, act.",
    ]
    return c.select(k.alias("k"), F.concat_ws("\n", *[F.lit(p) if isinstance(p, str) else p for p in parts]).alias("text"))


@query("""with b as (select c_custkey as k, c_custkey % 7 as v, ['Super Typhoon', 'Severe Tropical Storm', 'Tropical Storm', 'Tropical Depression', 'Typhoon'][c_custkey % 5 + 1] as category,
  make_date(2026::bigint, 1 + c_custkey % 12, 1 + c_custkey % 28) as day, c_custkey % 12 + 1 as hour, n_name, c_custkey % 3 = 0 as located, c_custkey % 6 = 0 as beyond from customer join nation on n_nationkey = c_nationkey)
select k, case when k % 11 != 0 or located then category end as category, case when k % 11 != 0 then 'X' || k end as name,
  strftime(day + to_hours((hour % 12 + case when k % 3 = 0 then 0 else 12 end)::int) + interval 5 minute, '%Y-%m-%d %H:%M:%S') as issued_at,
  case k % 4 when 0 then strftime(day, '%Y-%m-%d') || ' 17:30:00' when 1 then strftime(day + interval 1 day, '%Y-%m-%d') || ' 05:30:00' when 2 then strftime(day, '%Y-%m-%d') || ' 17:30:00' else strftime(day + interval 9 day, '%Y-%m-%d') || ' 05:30:00' end as next_at,
  case v when 0 then 'X' || k || ' IS ABOUT TO EXIT THE AREA.' when 1 then 'X' || k || ' HAS EXITED THE AREA OF RESPONSIBILITY.' when 4 then 'X' || k || ' MAINTAINS ITS STRENGTH.' when 5 then 'X' || k || ' LEFT AND IS LIKELY TO RE-ENTER IT.' end as headline,
  'Seas off ' || n_name as coast, case when located then (k % 30)::double end as lat, case when located then 120.5 + k % 10 end::double as lon, 'Moving West at 10 km/h' as movement, (k % 200)::int as wind_kmh, (k % 250)::int as gust_kmh,
  2 as n_forecasts, strftime(day + interval 1 day, '%Y-%m-%d') || ' 08:00:00' as last_forecast_at, false as last_outside,
  case when (beyond or v in (1, 5)) and (k % 4 = 0 or v = 5) then 'entering' when beyond or v in (1, 5) then 'outside' when v = 0 then 'exiting' when located then 'inside' else 'unknown' end as status,
  case when k % 11 = 0 then 'no name' end as reason from b""")
def bulletin_fields(spark, d):
    """What bulletins tell: class, name, times, headline, sections, centre, winds, forecasts and where the cyclone is."""
    from hazardloom.functions.bulletins import fields

    last, found = F.get("forecasts", 1), fields(_bulletins(spark, d), "text")
    return found.select(
        "k", "category", "name", D.stamp("issued_at").alias("issued_at"), D.stamp("next_at").alias("next_at"), "headline", "coast", "lat", "lon", "movement", "wind_kmh", "gust_kmh",
        F.size("forecasts").alias("n_forecasts"), D.stamp(last["at"]).alias("last_forecast_at"), last["outside"].alias("last_outside"), "status", "reason",
    )
