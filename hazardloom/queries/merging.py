"""Keyed merges, differences and delivery plans, on splits of ``events`` and ``orders``."""

from pyspark.sql import functions as F

from hazardloom.functions.text import row_hash, sql_literal
from hazardloom.operators import aggregates as A
from hazardloom.operators import merge as M
from hazardloom.operators.batches import delete_statements as delete_texts
from hazardloom.operators.batches import insert_statements as insert_texts
from hazardloom.operators.batches import statement_batches as dealt_batches
from hazardloom.operators.digests import changed_rows, digest_tree, group_digest, tree_diff
from hazardloom.operators import polling
from hazardloom.functions import bulletins as B
from hazardloom.functions.dates import local_time, stamp
from hazardloom.functions.text import bulletin_text
from hazardloom.queries import query
from hazardloom.sources.tables import table


def _old_and_new(spark, d):
    """The state before and what comes in: some rows are the same, some changed, some new, some gone."""
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    old = e.where("event_id % 5 != 0")
    new = e.where("event_id % 7 != 1").withColumn("event_type", F.when(F.col("event_id") % 11 == 3, F.lit("")).otherwise(F.col("event_type")))
    return old, new


_SPLIT = """o as (select event_id, user_id, event_type, value from events where event_id % 5 != 0),
n as (select event_id, user_id, case when event_id % 11 = 3 then '' else event_type end as event_type, value from events where event_id % 7 != 1)"""


@query(f"""with {_SPLIT} select coalesce(n.event_id, o.event_id) as event_id, coalesce(n.user_id, o.user_id) as user_id,
  case when n.event_id is not null then n.event_type else o.event_type end as event_type, coalesce(n.value, o.value) as value,
  case when n.event_id is null or (n.user_id, n.event_type, n.value) = (o.user_id, o.event_type, o.value) then 'same' when o.event_id is null then 'insert' else 'update' end as change
from o full outer join n on o.event_id = n.event_id""")
def upsert(spark, d):
    return M.upsert(*_old_and_new(spark, d), ["event_id"])


@query("""with n as (select o_custkey as k, arg_max(o_totalprice, o_orderkey) as v from orders where o_custkey % 3 != 0 group by 1)
select coalesce(k, c_custkey) as c_custkey, coalesce(v, c_acctbal) as value, case when k is null or v = c_acctbal then 'same' when c_custkey is null then 'insert' else 'update' end as change
from (select c_custkey, c_acctbal from customer where c_custkey % 5 != 0) full outer join n on c_custkey = k""")
def upsert_repeated_keys(spark, d):
    """A batch that repeats keys: the last row by sequence wins."""
    old = table(spark, d, "customer").where("c_custkey % 5 != 0").select("c_custkey", F.col("c_acctbal").alias("value"))
    new = table(spark, d, "orders").where("o_custkey % 3 != 0").select(F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("value"), "o_orderkey")
    return M.upsert(old, new, ["c_custkey"], F.col("o_orderkey"))


@query(f"with {_SPLIT} select event_id, event_type from n where event_id not in (select event_id from o)")
def append_new(spark, d):
    return M.append_new(*_old_and_new(spark, d), "event_id").select("event_id", "event_type")


@query(f"""with {_SPLIT}, a as (select event_type, count(*) as c from o group by 1), b as (select event_type, count(*) as c from n group by 1),
x as (select event_type, count(*) as c from n where not exists (select 1 from o where o.event_id = n.event_id and o.user_id = n.user_id and o.event_type = n.event_type and o.value = n.value) group by 1)
select coalesce(a.event_type, b.event_type) as event_type, coalesce(a.c, 0) as n_old, coalesce(b.c, 0) as n_new, coalesce(b.c, 0) >= coalesce(a.c, 0) * 0.95 as replaced,
  case when coalesce(b.c, 0) >= coalesce(a.c, 0) * 0.95 then coalesce(x.c, 0) + greatest(0, coalesce(a.c, 0) - coalesce(b.c, 0)) else 0 end as changed
from a full outer join b on a.event_type = b.event_type left join x on x.event_type = coalesce(a.event_type, b.event_type)""")
def replace_guarded(spark, d):
    return M.replace_guarded(*_old_and_new(spark, d), "event_type")


@query(f"""with {_SPLIT} select coalesce(n.event_id, o.event_id) as event_id, case when o.event_id is null then 'insert' when n.event_id is null then 'delete' else 'update' end as change
from o full outer join n on o.event_id = n.event_id where (o.user_id, o.event_type, o.value) is distinct from (n.user_id, n.event_type, n.value)""")
def rowhash_diff(spark, d):
    return M.rowhash_diff(*_old_and_new(spark, d), ["event_id"])


@query(f"""with {_SPLIT} select n.event_id, case when o.event_id is null then 'insert' else 'update' end as change
from n left join o on o.event_id = n.event_id where o.event_id is null or (o.user_id, o.event_type, o.value) != (n.user_id, n.event_type, n.value)""")
def rowhash_diff_keeping(spark, d):
    """The same for tables whose vanished rows stay where they were sent."""
    return M.rowhash_diff(*_old_and_new(spark, d), ["event_id"], deletes=False)


@query("select event_id from events where ts > (select max(ts) from events where event_id % 2 = 0 and ts < timestamp '2024-01-20')")
def watermark_diff(spark, d):
    e = table(spark, d, "events")
    mark = e.where("event_id % 2 = 0 and ts < timestamp_ntz '2024-01-20'").agg(F.max("ts")).scalar()
    return M.past_watermark(e, "ts", mark).select("event_id")


@query("with m as (select event_type, max(ts) as w from events where event_id % 3 = 0 group by 1) select event_type, count(*) filter (ts <= w and event_id % 3 = 1) as late from events join m using (event_type) group by 1")
def late_rows(spark, d):
    """Rows that came after their source's mark had passed them, which are never sent."""
    e = table(spark, d, "events")
    marks = e.where("event_id % 3 = 0").groupBy("event_type").agg(F.max("ts").alias("w"))
    return e.join(marks, "event_type").groupBy("event_type").agg(F.count_if((F.col("ts") <= F.col("w")) & (F.col("event_id") % 3 == 1)).alias("late"))


def _digests(spark, d):
    o = table(spark, d, "orders")
    hashed = row_hash(F.col("o_orderkey"), F.col("o_orderstatus"))
    month = F.date_format("o_orderdate", "yyyy-MM")
    now = o.where("year(o_orderdate) > 1995")
    return group_digest(o.where("o_orderkey % 100 != 0 or month(o_orderdate) < 7"), month, hashed), group_digest(now, month, hashed)


_SUM = "count(*) || ':' || sum(('0x' || substr(h, 1, 8))::bigint) || ':' || sum(('0x' || substr(h, 9, 8))::bigint)"
_DIGESTS = f"""h as (select *, strftime(o_orderdate, '%Y-%m') as g, substr(sha256(concat_ws(chr(31), coalesce(o_orderkey::varchar, chr(0)), coalesce(o_orderstatus, chr(0)))), 1, 16) as h from orders),
a as (select g, substr(sha256({_SUM}), 1, 16) as d from h where o_orderkey % 100 != 0 or month(o_orderdate) < 7 group by g),
b as (select g, count(*) as n, substr(sha256({_SUM}), 1, 16) as d from h where year(o_orderdate) > 1995 group by g)"""


@query(f"""with {_DIGESTS} select coalesce(a.g, b.g) as "group", coalesce(n, 0) as n, case when a.g is null then 'new' when b.g is null then 'gone' when a.d = b.d then 'same' else 'changed' end as state
from a full outer join b on a.g = b.g""")
def month_digest_diff(spark, d):
    return M.digest_diff(*_digests(spark, d))


_TREES = """h as (select o_orderkey as k, strftime(o_orderdate, '%Y-%m') as g, substr(md5(o_orderkey::varchar), 1, 2) as leaf, o_orderstatus as s from orders),
old as (select k, g, leaf, case when k % 500 = 0 then 'X' else s end as s from h where k % 450 != 7 and g < '2000-12'), new as (select * from h where k % 330 != 11 and g != '1995-01'),
o as (select g, left(leaf, l) as prefix, count(*) as n, string_agg(k || s, ',' order by k) as d from old, range(3) as r(l) group by 1, 2),
n as (select g, left(leaf, l) as prefix, count(*) as n, string_agg(k || s, ',' order by k) as d from new, range(3) as r(l) group by 1, 2)"""


def _trees(spark, d):
    month = F.date_format("o_orderdate", "yyyy-MM")
    o = table(spark, d, "orders").select("o_orderkey", month.alias("group"), F.col("o_orderstatus").alias("s"))
    old = o.where("o_orderkey % 450 != 7 and group < '2000-12'").withColumn("s", F.when(F.col("o_orderkey") % 500 == 0, "X").otherwise(F.col("s")))
    new = o.where("o_orderkey % 330 != 11 and group != '1995-01'")
    return [rows.select("group", "o_orderkey", row_hash(F.col("o_orderkey"), F.col("s")).alias("hash")) for rows in (old, new)]


@query(f"""with {_TREES} select coalesce(o.g, n.g) as "group", coalesce(o.prefix, n.prefix) as prefix, coalesce(o.n, 0) as n_old, coalesce(n.n, 0) as n_new
from o full outer join n on o.g = n.g and o.prefix = n.prefix where o.d is distinct from n.d""")
def digest_tree_diff(spark, d):
    """The months and parts of months in which two states of the orders differ, found from the top of two digest trees."""
    old, new = _trees(spark, d)
    return tree_diff(digest_tree(old, "o_orderkey"), digest_tree(new, "o_orderkey"))


@query(f"""with {_TREES} select coalesce(old.g, new.g) as "group", coalesce(old.k, new.k) as o_orderkey, case when old.k is null then 'insert' when new.k is null then 'delete' else 'update' end as change
from old full outer join new using (g, k) where old.s is distinct from new.s""")
def digest_tree_rows(spark, d):
    """The rows that differ, compared only in the leaves that do."""
    old, new = _trees(spark, d)
    return changed_rows(old, new, tree_diff(digest_tree(old, "o_orderkey"), digest_tree(new, "o_orderkey")), "o_orderkey")


@query("""with h as (select o_orderkey as k, strftime(o_orderdate, '%Y-%m') as g, o_orderstatus as s from orders),
old as (select k, g, case when k % 150 = 0 then 'X' else s end as s from h where k % 100 != 0 or g < '1997-07'), new as (select * from h where g >= '1996-01' and (k % 97 != 0 or g like '%-03')),
od as (select g, string_agg(k || s, ',' order by k) as d from old group by g), nd as (select g, string_agg(k || s, ',' order by k) as d from new group by g),
c as (select nd.g, od.g is not null as sent, od.g is not null and nd.g >= '1999-01' as known from nd left join od on od.g = nd.g where nd.d is distinct from od.d)
select g as "group", k as o_orderkey, 'insert' as change from new join c using (g) where not known
union all select g, null, 'clear' from c where sent and not known
union all select g, new.k, case when old.k is null then 'insert' else 'update' end from new join c using (g) left join old using (g, k) where known and old.s is distinct from new.s
union all select g, old.k, 'delete' from old join c using (g) left join new using (g, k) where known and new.k is null""")
def month_changes(spark, d):
    """What is sent of changed months: single rows of those from 1999 on, whose old rows are known, else whole months."""
    month = F.date_format("o_orderdate", "yyyy-MM")
    o = table(spark, d, "orders").select("o_orderkey", month.alias("group"), F.col("o_orderstatus").alias("s"))
    old = o.where("o_orderkey % 100 != 0 or group < '1997-07'").withColumn("s", F.when(F.col("o_orderkey") % 150 == 0, "X").otherwise(F.col("s")))
    new = o.where("group >= '1996-01' and (o_orderkey % 97 != 0 or group like '%-03')")
    hashed = row_hash(F.col("o_orderkey"), F.col("s"))
    digest = lambda rows: group_digest(rows, F.col("group"), hashed)
    rows = lambda part: part.select("group", "o_orderkey", hashed.alias("hash"))
    return M.month_changes(digest(old), rows(old.where("group >= '1999-01'")), digest(new), rows(new), "o_orderkey")


@query(f"""with {_DIGESTS}, s as (select b.g, case when a.d is not distinct from b.d then 0 else n end as n from b left join a on a.g = b.g),
r as (select g, n, row_number() over (order by g desc) as k from s), o as (select *, case when k > 2 then n else 0 end as r from r),
t as (select *, sum(r) over (order by g desc) as sf, sum((r > 0)::int) over (order by g desc) as wr from o),
x as (select *, k <= 2 or r = 0 or sf <= 900 or wr = 1 as ok from t)
select g as "group", n, k::int as rank, ok and max((not ok)::int) over (order by g desc) = 0 as taken from x""")
def month_plan_budget(spark, d):
    """Which changed months a run delivers: the two newest, then older ones within 900 rows."""
    diff = M.digest_diff(*_digests(spark, d)).where("state != 'gone'")
    return M.budget_plan(diff.withColumn("n", F.when(F.col("state") == "same", 0).otherwise(F.col("n"))), "group", "n", 900)


@query("""with r as (select o_custkey, o_orderkey, octet_length(encode('(' || o_orderkey || ',''' || o_orderpriority || ''')')) as size, row_number() over (partition by o_custkey order by o_orderkey) as k from orders),
f as (with recursive f as (select o_custkey, o_orderkey, k, size as held, 0 as batch from r where k = 1
  union all select r.o_custkey, r.o_orderkey, r.k, case when held + size <= 60 then held + size else size end, case when held + size <= 60 then batch else batch + 1 end
  from f join r on r.o_custkey = f.o_custkey and r.k = f.k + 1) select * from f)
select o_custkey, o_orderkey, batch::int as batch from f""")
def statement_batches(spark, d):
    """Rows as SQL values, batched by bytes."""
    value = F.concat(F.lit("("), sql_literal(F.col("o_orderkey").cast("string"), True), F.lit(","), sql_literal(F.col("o_orderpriority"), False), F.lit(")"))
    return dealt_batches(table(spark, d, "orders").withColumn("value", value), "o_custkey", "o_orderkey", "value", 60)


@query(f"with {_SPLIT} select event_id, user_id, event_type, value from n")
def apply_changes(spark, d):
    """What a delivery makes of the old state: the new one."""
    old, new = _old_and_new(spark, d)
    return M.apply_changes(old, M.change_set(old, new, ["event_id"]), ["event_id"])


@query(f"with {_SPLIT} select event_id, user_id, event_type, value from n union all select event_id, user_id, event_type, value from o where event_id not in (select event_id from n)")
def apply_changes_keeping(spark, d):
    """The same for tables whose vanished rows stay where they were sent."""
    old, new = _old_and_new(spark, d)
    return M.apply_changes(old, M.change_set(old, new, ["event_id"], deletes=False), ["event_id"])


@query("""with h as (select o_orderkey, strftime(o_orderdate, '%Y-%m') as g, o_orderstatus as s, o_totalprice from orders),
old as (select o_orderkey, g, case when o_orderkey % 150 = 0 then 'X' else s end as s, o_totalprice from h where o_orderkey % 100 != 0 or g < '1997-07'), new as (select * from h where g >= '1996-01' and g != '1998-02' and (o_orderkey % 97 != 0 or g like '%-03'))
select o_orderkey, g as "group", s, o_totalprice from new union all select o_orderkey, g, s, o_totalprice from old where g not in (select g from new) and g >= '1994-06'""")
def apply_month_changes(spark, d):
    """Changed months applied: rows of known months one by one, others cleared and sent whole, vanished ones kept, and those before the window dropped."""
    o = table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("group"), F.col("o_orderstatus").alias("s"), "o_totalprice")
    old = o.where("o_orderkey % 100 != 0 or group < '1997-07'").withColumn("s", F.when(F.col("o_orderkey") % 150 == 0, "X").otherwise(F.col("s")))
    new = o.where("group >= '1996-01' and group != '1998-02' and (o_orderkey % 97 != 0 or group like '%-03')")
    hashed = row_hash(F.col("o_orderkey"), F.col("s"), F.col("o_totalprice"))
    digest = lambda rows: group_digest(rows, F.col("group"), hashed)
    known = old.where("group >= '1999-01'").select("group", "o_orderkey", hashed.alias("hash"))
    changes = M.month_change_set(digest(old), known, digest(new), new, "o_orderkey", hashed, F.lit("1994-06"))
    return M.apply_changes(old, changes, ["o_orderkey"], "group")


@query(f"""with h as (select *, strftime(o_orderdate, '%Y-%m') as g, substr(sha256(concat_ws(chr(31), coalesce(o_orderkey::varchar, chr(0)), coalesce(o_orderstatus, chr(0)))), 1, 16) as h from orders)
select g as "group", o_orderkey, h as hash from h where g in (select distinct g from h order by g desc limit 2)""")
def newest_hashes(spark, d):
    """Row hashes of the two newest months, which are all that a manifest keeps."""
    o = table(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("group"), "o_orderkey", row_hash(F.col("o_orderkey"), F.col("o_orderstatus")).alias("hash"))
    newest = o.select("group").distinct().orderBy(F.desc("group")).limit(2)
    return o.join(newest, "group", "left_semi")


_VALUES = """r as (select strftime(o_orderdate, '%Y-%m') as month, o_orderkey, '(' || o_orderkey || ', ' || '''' || o_orderpriority || '''' || ', ' || case when o_orderkey % 7 = 0 then 'NULL' else '''it''''s ' || o_custkey || '''' end || ')' as v from orders),
s as (select *, octet_length(encode(v)) + 2 as size, row_number() over (partition by month order by o_orderkey) as k from r)"""


@query(f"""with {_VALUES},
f as (with recursive f as (select month, o_orderkey, v, k, size as held, 0 as batch from s where k = 1
  union all select s.month, s.o_orderkey, s.v, s.k, case when held + size <= 900 - 64 then held + size else size end, case when held + size <= 900 - 64 then batch else batch + 1 end
  from f join s on s.month = f.month and s.k = f.k + 1) select * from f)
select month, batch::int as batch, count(*) as rows, md5('INSERT OR REPLACE INTO sent (o_orderkey, priority, note) VALUES' || chr(10) || string_agg(v, ',' || chr(10) order by o_orderkey) || ';') as h from f group by month, batch""")
def insert_statements(spark, d):
    """The SQL text of each month's rows, statements of at most 900 bytes."""
    k = F.col("o_orderkey")
    note = F.when(k % 7 == 0, "").otherwise(F.concat(F.lit("it's "), F.col("o_custkey").cast("string")))
    rows = table(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderkey", F.col("o_orderpriority").alias("priority"), note.alias("note"))
    return insert_texts(rows, "sent", ["o_orderkey", "priority", "note"], ["o_orderkey"], "month", "o_orderkey", 900).select("month", "batch", "rows", F.md5("statement").alias("h"))


@query("""with g as (select o_orderkey, '(o_orderkey = ' || o_orderkey || ' AND o_orderstatus = ''' || o_orderstatus || ''')' as v, (row_number() over (order by o_orderkey) - 1) // 200 as batch from orders where o_orderkey % 3 = 0)
select batch::int as batch, count(*) as rows, md5('DELETE FROM sent WHERE ' || string_agg(v, ' OR ' order by o_orderkey) || ';') as h from g group by batch""")
def delete_statements(spark, d):
    """The SQL text that deletes vanished rows by their keys, 200 a statement."""
    gone = table(spark, d, "orders").where("o_orderkey % 3 = 0").select("o_orderkey", "o_orderstatus")
    return delete_texts(gone, "sent", ["o_orderkey", "o_orderstatus"], ["o_orderkey"], "o_orderkey").select("batch", "rows", F.md5("statement").alias("h"))


@query("""select strftime(o_orderdate, '%Y-%m') as month, count(*) as n from orders where o_orderdate < date_trunc('month', (select max(o_orderdate) from orders)) - interval 23 month group by 1""")
def retention_deletes(spark, d):
    """Months that the sliding window of 24 months has left behind."""
    o = table(spark, d, "orders")
    first = F.add_months(F.trunc(A.newest(o, "o_orderdate").cast("date"), "MM"), -23)
    return o.where(F.to_date("o_orderdate") < first).groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query("""with done as (select distinct strftime(o_orderdate, '%Y-%m') as m from orders where o_orderkey % 50 = 0),
all_months as (select strftime(unnest(generate_series(timestamp '1996-01-01', timestamp '2001-06-01', interval 1 month)), '%Y-%m') as month)
select month from all_months where month not in (select m from done) order by month limit 12""")
def backfill_months(spark, d):
    """The next months of a range that are not done yet."""
    done = table(spark, d, "orders").where("o_orderkey % 50 = 0").select(F.date_format("o_orderdate", "yyyy-MM").alias("month")).distinct()
    months = spark.range(1).select(F.explode(F.expr("sequence(date'1996-01-01', date'2001-06-01', interval 1 month)")).alias("m")).select(F.date_format("m", "yyyy-MM").alias("month"))
    return months.join(done, "month", "left_anti").orderBy("month").limit(12)


@query("""with t as (select text, doc_id, sha256(coalesce(text, '')) as h from documents), k as (select *, row_number() over (partition by text order by doc_id) as k from t)
select doc_id, substr(h, 1, 16) as sha from k where k = 1 and doc_id % 3 != 0 and text not in (select text from documents where doc_id % 3 = 0)""")
def append_bulletins(spark, d):
    """New bulletins: of a batch those whose text is not stored, each text once, named by its hash."""
    t = table(spark, d, "documents").select("doc_id", "text")
    fresh = A.per_key_first(t, ["text"], F.col("doc_id")).where("doc_id % 3 != 0")
    stored = t.where("doc_id % 3 = 0").select("text")
    return fresh.join(stored, "text", "left_anti").select("doc_id", F.substring(F.sha2(F.coalesce("text", F.lit("")), 256), 1, 16).alias("sha"))


@query("""with s as (select event_type, max(ts) as last_fetch, max(case when event_id % 4 != 0 then ts end) as last_ok, max_by(event_id % 4, ts) as code from events group by 1), n as (select max(ts) as now from events)
select event_type, code = 3 and last_fetch + interval 6 hour > now as cooling, last_ok + interval 29 minute <= now as due from s cross join n""")
def poll_gates(spark, d):
    """Which sources a run may ask: not cooling down after a block, and due."""
    e = table(spark, d, "events")
    now = e.agg(F.max("ts")).scalar()
    s = e.groupBy("event_type").agg(F.max("ts").alias("last_fetch"), F.max(F.when(F.col("event_id") % 4 != 0, F.col("ts"))).alias("last_ok"), F.max_by(F.col("event_id") % 4, "ts").alias("code"))
    cooling = (F.col("code") == 3) & (F.col("last_fetch") + F.expr("interval 6 hours") > now)
    return s.select("event_type", cooling.alias("cooling"), (F.col("last_ok") + F.expr("interval 29 minutes") <= now).alias("due"))


def _polls(spark, d):
    k = F.col("event_id")
    status = F.when(k % 13 == 0, 403).when(k % 13 == 1, 429).when(k % 13 == 2, 304).when(k % 13 == 3, 500).otherwise(200)
    return table(spark, d, "events").select(
        F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("source"), F.col("ts").alias("at"), status.alias("status"), F.col("event_type").alias("note"),
        (k % 5 != 0).alias("ok"), (k % 17 == 4).alias("challenge"), F.concat(F.lit("e"), k.cast("string")).alias("etag"), F.col("user_id").cast("string").alias("last_modified"),
    )


@query(f"""with p as (select user_id || '-' || event_type as source, ts as "at", case event_id % 13 when 0 then 403 when 1 then 429 when 2 then 304 when 3 then 500 else 200 end as status, event_type as note, event_id % 5 != 0 as ok, event_id, user_id,
  case when event_id % 17 = 4 then 24 when event_id % 13 = 0 then 24 when event_id % 13 = 1 then 6 end as hours from events),
old as (select * from p where "at" < timestamp '2024-01-10'), new as (select * from p where "at" >= timestamp '2024-01-10'),
s as (select source, max("at") filter (hours is null) as lf, arg_max(status, "at") filter (hours is null) as ls, max("at") filter (hours is null and ok and status = 200) as lo, arg_max(event_id, "at") filter (hours is null and ok and status = 200) as e,
  arg_max("at" + to_hours(hours), "at") filter (hours is not null) as c from p group by source)
select source, strftime(lf, '%Y-%m-%d %H:%M:%S') as last_fetch, ls::int as last_status, strftime(lo, '%Y-%m-%d %H:%M:%S') as last_ok, 'e' || e as etag, strftime(c, '%Y-%m-%d %H:%M:%S') as cooldown_until,
  coalesce(c > (select max("at") from p), false) as cooling, lf is null or lf + interval 59 minute <= (select max("at") from p) as due from s""")
def poll_states(spark, d):
    """The states of sources after two runs of polls, and which of them may be asked again."""
    polls = _polls(spark, d)
    states = spark.createDataFrame([], "source string, last_fetch timestamp_ntz, last_status int, last_note string, last_ok timestamp_ntz, etag string, last_modified string, cooldown_until timestamp_ntz")
    for run in ("at < timestamp_ntz '2024-01-10'", "at >= timestamp_ntz '2024-01-10'"):
        states = polling.states_after(states, polls.where(run))
    may = polling.may_poll(states, polls.agg(F.max("at")).scalar(), F.lit(59))
    return states.join(may, "source").select("source", stamp("last_fetch").alias("last_fetch"), "last_status", stamp("last_ok").alias("last_ok"), "etag", stamp("cooldown_until").alias("cooldown_until"), "cooling", "due")


@query("select event_id, strftime(ts + interval 8 hour, '%Y-%m-%dT%H:%M:%S') || '+08:00' as at_local, strftime(ts + interval 8 hour, '%Y-%m') as month from events")
def local_times(spark, d):
    """UTC times as the local text of row files, and the month that they belong to there."""
    local = local_time(F.col("ts"))
    return table(spark, d, "events").select("event_id", local.alias("at_local"), F.substring(local, 1, 7).alias("month"))


_LINES = """l as (select doc_id, list_transform(string_split(text, chr(10)), lambda x: case when regexp_matches(trim(x, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)), '^(TOS|Previous Next)$|-->$') then '' else trim(x, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) end) as a from documents),
p as (select doc_id, a, list_filter(range(1, len(a) + 1), lambda i: a[i] != '') as p from l),
j as (select doc_id, a, p, list_filter(range(1, len(p) + 1), lambda q: q = 1 or a[p[q]] != a[p[q - 1]]) as j from p),
clean as (select doc_id, array_to_string(list_transform(j, lambda q: case when q = 1 then '' when p[q] - p[q - 1] > 1 then chr(10) || chr(10) else chr(10) end || a[p[q]]), '') as t from j)"""


@query(f"with {_LINES} select doc_id, md5(t) as h, length(t) as n from clean")
def clean_bulletins(spark, d):
    """Texts without marks, blank runs and repeated lines."""
    clean = bulletin_text(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.md5(clean).alias("h"), F.length(clean).alias("n"))


@query(f"with {_LINES} select md5(t) as text_md5, min(doc_id) as doc_id, arg_min(substr(sha256(text), 1, 16), doc_id) as sha, count(*) as n from clean join documents using (doc_id) group by t")
def compact_bulletins(spark, d):
    """Of texts that are equal when cleaned the earliest, under the hash that it was stored by."""
    rows = table(spark, d, "documents").select("doc_id", bulletin_text(F.col("text")).alias("t"), F.substring(F.sha2("text", 256), 1, 16).alias("sha"))
    return M.compact_texts(rows, "t", "doc_id", "sha").select(F.md5("t").alias("text_md5"), "doc_id", "sha", "n")


@query("""with d as (select doc_id, case when doc_id % 4 = 0 then '' else 'Typhoon "X' || doc_id % 40 || '"' || chr(10) end || case when doc_id % 7 = 0 then '' else 'Issued at 05:00 pm, ' || (1 + doc_id % 28) || ' September 2026' || chr(10) end || coalesce(lang, '') || doc_id % 300 as t from documents),
good as (select * from d where doc_id % 4 != 0 and doc_id % 7 != 0 and doc_id % 3 != 0), stored as (select t, case when doc_id % 2 = 0 then substr(sha256(t), 1, 16) else 'old' || doc_id end as sha from d where doc_id % 3 = 0)
select doc_id, substr(sha256(t), 1, 16) as sha from good where t not in (select t from stored) and substr(sha256(t), 1, 16) not in (select sha from stored)""")
def append_checked_bulletins(spark, d):
    """New bulletins: texts that are bulletins at all and that neither their text nor their hash says are stored."""
    k, s = F.col("doc_id"), lambda c: c.cast("string")
    title = F.when(k % 4 == 0, "").otherwise(F.concat(F.lit('Typhoon "X'), s(k % 40), F.lit('"\n')))
    issued = F.when(k % 7 == 0, "").otherwise(F.concat(F.lit("Issued at 05:00 pm, "), s(k % 28 + 1), F.lit(" September 2026\n")))
    rows = table(spark, d, "documents").select("doc_id", F.concat(title, issued, F.coalesce("lang", F.lit("")), s(k % 300)).alias("text"))
    rows = rows.withColumn("sha", F.substring(F.sha2("text", 256), 1, 16))
    stored = rows.where("doc_id % 3 = 0").withColumn("sha", F.when(k % 2 == 0, F.col("sha")).otherwise(F.concat(F.lit("old"), s(k))))
    return B.append_new_bulletins(stored, rows.where("doc_id % 3 != 0"), "text", "sha").select("doc_id", "sha")
