"""DuckDB SQL of the registered queries, over the same derived inputs."""

from __future__ import annotations

INPUTS = """
with fx_order as (
  select o_orderkey as productionorderid,
    'mes_' || case when o_orderkey % 2 = 0 then 'old' else 'new' end || '_' || (['zh', 'zz', 'hf', 'wh', 'cq'])[n_regionkey + 1] as db_name,
    case when o_orderkey % 33 = 0 then 'FG-' else 'PO-' end || cast(o_orderkey // 2 as varchar) as productionorderno,
    20 + o_orderkey % 181 as orderquantity,
    case when o_orderkey % 200 = 3 then 9999 else n_nationkey end as worksiteid,
    case when o_orderkey % 200 = 3 then 999999999 else o_custkey end as partid,
    o_orderdate as createddate,
    case when o_orderkey % 100 = 7 then o_orderdate - interval 1 hour else o_orderdate + to_days(cast(3 + o_orderkey % 13 as integer)) end as duedate,
    o_custkey as custkey, c_name as custname
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
), fx_line as (
  select *, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) as ver,
    count(*) over (partition by l_orderkey, l_linenumber) as nver
  from lineitem
), fx_log as (
  select db_name, case when db_name like 'mes_old_%' and l_linenumber >= 5 then 'barcodeautomatic' else 'lot' end as tbl_name,
    case when ver = 1 then 'c' when ver = nver and l_returnflag = 'R' then 'd' else 'u' end as op,
    cast(l_orderkey * 10 + l_linenumber as varchar) as record_id, ver as version, ver as seq, productionorderid,
    l_suppkey as workcenterid, custkey as createdbyid, case when l_quantity <= 1 then 0 else l_quantity end as qty,
    createddate + to_days(cast(abs(date_diff('day', createddate, l_shipdate)) % 20 as integer)) + to_seconds((l_orderkey * 7919 + l_linenumber * 104729) % 86400) as event_time,
    'LOT-' || cast(l_orderkey * 10 + l_linenumber as varchar) as lotno, 'LPN-' || cast(l_orderkey as varchar) as lpnbarcode,
    'PN' || lpad(cast(partid as varchar), 6, '0') as modelencode, p_name as model, custname as users
  from fx_line join fx_order on l_orderkey = productionorderid left join part on p_partkey = partid
), fx_wide as (
  select l.db_name, l.tbl_name, l.op, l.seq, l.record_id, l.version, split_part(l.db_name, '_', 3) as company,
    case when l.db_name like 'mes_old_%' then 'OLD_MES' else 'NEW_MES' end as datasource,
    case when l.tbl_name = 'lot' then 'MANUAL' else 'BARCODE' end as outputtype,
    o.productionorderno as productionorder, l.productionorderid,
    case when l.tbl_name = 'lot' then lotno else lpnbarcode end as lpnbarcode,
    case when l.tbl_name = 'lot' then u.c_name else users end as username,
    case when l.tbl_name = 'lot' then 'PN' || lpad(cast(p.p_partkey as varchar), 6, '0') else modelencode end as partcode,
    case when l.tbl_name = 'lot' then p.p_name else model end as partname,
    s.s_name as linecode, 'Line ' || cast(s.s_suppkey as varchar) as linename, cast(s.s_nationkey % 6 as varchar) as workcentertype,
    n.n_name as workshop, o.orderquantity, o.createddate as ordercreateddate, o.duedate as orderduedate, l.qty as lotquantity,
    l.event_time as outputdatetime, cast(l.event_time - interval 510 minutes as date) as shift_date, l.op = 'd' as is_deleted
  from fx_log l left join fx_order o on l.db_name = o.db_name and l.productionorderid = o.productionorderid
    left join part p on l.tbl_name = 'lot' and p.p_partkey = o.partid
    left join supplier s on l.tbl_name = 'lot' and s.s_suppkey = l.workcenterid
    left join customer u on l.tbl_name = 'lot' and u.c_custkey = l.createdbyid
    left join nation n on n.n_nationkey = coalesce(o.worksiteid, s.s_nationkey)
), fx_last as (
  select * from fx_log qualify row_number() over (partition by db_name, tbl_name, record_id order by version desc, seq desc) = 1
), fx_counts as (
  select *, lotquantity > 0 and (productionorder is null or productionorder not like 'FG%') as counts from fx_wide
), fx_live as (
  select * exclude (counts) from (select * from fx_counts qualify row_number() over (partition by db_name, tbl_name, record_id order by version desc, seq desc) = 1) where counts and not is_deleted
), fx_seen as (
  select *, counts and not is_deleted as live, lag(counts and not is_deleted) over w as was, lag(lotquantity) over w as old_qty, lag(outputdatetime) over w as old_time,
    lag(workshop) over w as old_workshop, lag(linecode) over w as old_line, lag(linename) over w as old_name, lag(partcode) over w as old_part
  from fx_counts window w as (partition by db_name, tbl_name, record_id order by version, seq)
), fx_delta as (
  select record_id, version, company, old_workshop as workshop, old_line as linecode, old_name as linename, old_part as partcode, old_time as outputdatetime, -old_qty as qty_delta, -1 as cnt_delta from fx_seen where was
  union all
  select record_id, version, company, workshop, linecode, linename, partcode, outputdatetime, lotquantity, 1 from fx_seen where live
), fx_minute as (
  select date_trunc('minute', outputdatetime) as ts_minute, company, workshop, linecode, partcode, min(linename) as linename, sum(qty_delta) as output_quantity, sum(cnt_delta) as record_cnt
  from fx_delta group by all having sum(qty_delta) <> 0 or sum(cnt_delta) <> 0
), fx_shift as (
  select shift_date, company, datasource, productionorder, any_value(productionorderid) as productionorderid, arg_max(workshop, version * 1000000000 + cast(record_id as bigint)) as workshop,
    max(orderquantity) as order_quantity, max(ordercreateddate) as created, max(orderduedate) as due, sum(lotquantity) as report_quantity, max(outputdatetime) as last_report_time
  from fx_live group by shift_date, company, datasource, productionorder
), fx_whole as (
  select company, datasource, productionorder, max(orderquantity) as order_quantity, max(ordercreateddate) as created, max(orderduedate) as due, sum(lotquantity) as report_quantity, max(outputdatetime) as last_report_time
  from fx_live group by company, datasource, productionorder
), fx_run as (
  select *, sum(lotquantity) over (partition by company, datasource, productionorder order by outputdatetime, record_id, outputtype rows unbounded preceding) as running from fx_live
), fx_run_shift as (
  select *, sum(lotquantity) over (partition by shift_date, company, datasource, productionorder order by outputdatetime, record_id, outputtype rows unbounded preceding) as running from fx_live
)
"""

NOW = "timestamp '1996-06-01 00:00:00'"
IDLE, STEP = 30 * 86400, 10 * 86400


def rate(part: str, whole: str) -> str:
    """Rounded half up at four places, in whole numbers."""
    return f"(case when {whole} > 0 then ((2 * cast({part} as bigint) * 10000 + {whole}) // (2 * {whole})) / 10000.0 else 0 end)"


def progress(created: str, due: str, now: str) -> str:
    span, gone = f"date_diff('second', {created}, {due})", f"date_diff('second', {created}, {now})"
    return f"(case when {span} > 0 then ((2 * greatest(0, least({gone}, {span})) * 10000 + {span}) // (2 * {span})) / 10000.0 else 0 end)"


def flags(rows: str, keys: str, running: str = "running") -> str:
    """Turns of an order into and out of lag, with the time of the next turn."""
    lags = f"(orderquantity > 0 and date_diff('second', ordercreateddate, orderduedate) > 0 and round({rate(running, 'orderquantity')} * 10000) < round({progress('ordercreateddate', 'orderduedate', 'outputdatetime')} * 10000) - 2000)"
    return f""", lagging as (select *, coalesce({lags}, false) as lags from {rows}),
    turned as (select *, coalesce(lag(lags) over w, false) as before from lagging window w as (partition by {keys} order by outputdatetime, record_id, outputtype)),
    turns as (select *, lead(outputdatetime) over (partition by {keys} order by outputdatetime, record_id, outputtype) as until from turned where lags <> before)"""


def stepped(alerts: str, carried: str) -> str:
    """The levels of alerts with alert_id, alert_time and recover_time, as rows of ``history``."""
    return f""", stepped as (
  select *, cast(least(2, greatest(0, (date_diff('second', alert_time, case when recover_time <= {NOW} then recover_time else {NOW} end) - case when recover_time <= {NOW} then 1 else 0 end) // {STEP})) as integer) as steps
  from {alerts} where alert_time <= {NOW}
), history as (
  select {carried}, alert_time, step, (['P3', 'P2', 'P1'])[step + 1] as level, alert_time + to_seconds(step * {STEP}) as changed from (select *, unnest(range(0, steps + 1)) as step from stepped)
  union all
  select {carried}, alert_time, 3, 'NONE', recover_time from stepped where recover_time <= {NOW}
)"""


GAPS = f""", gaps as (
  select 'MISSING_REPORT:' || company || ':' || linecode as alert_id, company, linecode, outputdatetime + to_seconds({IDLE}) as alert_time, next as recover_time
  from (select *, lead(outputdatetime) over (partition by company, linecode order by outputdatetime, record_id, outputtype) as next from fx_live where coalesce(linecode, '') <> '' and outputdatetime <= {NOW})
  where coalesce(next, {NOW}) >= outputdatetime + to_seconds({IDLE})
)""" + stepped("gaps", "alert_id, company, linecode")
DIGEST = """, raised as (
  select date_trunc('day', changed) as flush, company, linecode, case level when 'P3' then 2 when 'P2' then 3 else 4 end as severity from history where level <> 'NONE'
), digest as (
  select cast(flush as timestamp) as flush, company, 'MISSING_REPORT' as alert_type, (['NONE', 'P3', 'P2', 'P1'])[max(severity)] as level, count(*) as alerts, count(distinct linecode) as items,
    '[' || (['NONE', 'P3', 'P2', 'P1'])[max(severity)] || '] MISSING_REPORT ' || company || ': ' || array_to_string(list_sort(list_distinct(list(linecode)))[1:20], ', ')
      || case when count(distinct linecode) > 20 then ' ... ' || count(distinct linecode) || ' items' else '' end as body
  from raised group by flush, company
)"""
LAST_LOT = "fx_last l join fx_order o on l.db_name = o.db_name and l.productionorderid = o.productionorderid where l.op <> 'd' and l.tbl_name = 'lot' and l.qty > 0 and o.productionorderno not like 'FG%'"
ORDER_ALERT = "company || ':' || datasource || ':' || productionorder"
ACHIEVED = f"select company, datasource, productionorder, {rate('report_quantity', 'order_quantity')} as achieve_rate, {progress('created', 'due', NOW)} as plan_progress, {rate('report_quantity', 'order_quantity')} >= 1 and {NOW} >= due as finished, {rate('report_quantity', 'order_quantity')} - {progress('created', 'due', NOW)} as progress_deviation from fx_whole"
MINUTES = "select * from fx_minute"
FLAT = "select op, record_id, db_name, finishedquantity, createddate, version_ms from routed"
ROUTED = """, imaged as (
  select *, lag(struct_pack(db := db_name, id := record_id, q := qty, t := event_time, v := version)) over (partition by db_name, tbl_name, record_id order by version, seq) as before from fx_log
), routed as (
  select op, case when op = 'd' then before.id else record_id end as record_id, case when op = 'd' then before.db else db_name end as db_name, case when op = 'd' then before.q else qty end as finishedquantity,
    case when op = 'd' then before.t else event_time end as createddate, 1000 * case when op = 'd' then before.v else version end as version_ms
  from imaged
)"""
TOTALS = f"""{flags('fx_run_shift', 'shift_date, company, datasource, productionorder')}{GAPS}, over_shift as (
  select * from fx_run_shift where orderquantity > 0 and running > orderquantity qualify row_number() over (partition by shift_date, company, datasource, productionorder order by outputdatetime, record_id, outputtype) = 1
), totals as (
  select 'OVER_REPORT' as alert_type, company, count(*) as alerts, 0 as recovered from over_shift group by company
  union all select 'LAG', company, count(*), count(until) from turns where lags group by company
  union all select 'MISSING_REPORT', company, count(*), count(recover_time) from gaps group by company
)"""

HISTORY = """, made as (select * replace (case when productionorderid % 50 = 9 then null else worksiteid end as worksiteid) from fx_order), history as (
  select *, 1 as v, 'c' as op from made union all select * replace (2 * orderquantity as orderquantity), 2, 'u' from made union all select * replace (2 * orderquantity as orderquantity), 4, 'd' from made where productionorderid % 10 = 7
)"""


def compared(base: str, keys: str) -> str:
    """Sums q of base and of live manual rows by keys, side by side; missing keys are equal."""
    return f""", base as ({base}), result as (select {keys}, sum(lotquantity) as q from fx_live where outputtype = 'MANUAL' group by all),
      sides as (select {keys}, q as b, 0 as r from base union all select {keys}, 0, q from result)
      select {keys}, sum(b) as baseline_qty, sum(r) as result_qty, sum(r) - sum(b) as diff, abs(sum(r) - sum(b)) <= 0.005 * abs(sum(b)) as within_tolerance from sides group by {keys}"""


BODIES: dict[str, str] = {
    "shift_days": """select record_id, version, cast(event_time - interval 510 minutes as date) as shift_date, date_diff('day', date '1970-01-01', cast(event_time - interval 510 minutes as date)) as epoch_day,
      cast(cast(event_time - interval 510 minutes as date) as timestamp) + interval 510 minutes as shift_start, cast(cast(event_time - interval 510 minutes as date) as timestamp) + interval 1950 minutes as shift_end,
      date_trunc('minute', event_time) as ts_minute, strftime(event_time, '%Y%m%d') as day from fx_log""",
    "site_parse": "select db_name, split_part(db_name, '_', 3) as company, case when db_name like 'mes_old_%' then 'OLD_MES' else 'NEW_MES' end as datasource, count(*) as changes from fx_log group by all",
    "unify_reports": """select db_name, tbl_name, op, record_id, version, seq, productionorderid, case when tbl_name = 'lot' then workcenterid end as workcenterid, case when tbl_name = 'lot' then createdbyid end as createdbyid,
      case when tbl_name = 'lot' then lotno end as lotno, case when tbl_name = 'lot' then qty end as finishedquantity, case when tbl_name = 'lot' then event_time end as createddate,
      case when tbl_name = 'lot' then 'MANUAL' else 'BARCODE' end as outputtype, case when tbl_name <> 'lot' then cast(qty as bigint) end as quantity, case when tbl_name <> 'lot' then event_time end as scantime,
      case when tbl_name <> 'lot' then lpnbarcode end as lpnbarcode, case when tbl_name <> 'lot' then modelencode end as modelencode, case when tbl_name <> 'lot' then model end as model, case when tbl_name <> 'lot' then users end as users,
      split_part(db_name, '_', 3) as company, case when db_name like 'mes_old_%' then 'OLD_MES' else 'NEW_MES' end as datasource from fx_log""",
    "multi_database": "select db_name, tbl_name, count(*) as changes, cast(sum(qty) as bigint) as qty from fx_log where tbl_name = 'barcodeautomatic' and db_name like 'mes_old_%' group by db_name, tbl_name",
    "snapshot_changes": "select db_name, case when op = 'c' then 0 else version end as version, count(*) as records, sum(qty) as qty from fx_log group by all",
    "route_envelope": ROUTED + FLAT,
    "json_roundtrip": ROUTED + FLAT,
    "order_changelog": f"{HISTORY} select op, db_name, productionorderid, productionorderno, orderquantity, coalesce(worksiteid, 0) as worksiteid, coalesce(partid, 0) as partid, createddate, duedate, 1000 * v as version_ms from history",
    "current_orders": f"{HISTORY} select db_name, productionorderid, productionorderno, orderquantity, nullif(worksiteid, 0) as worksiteid, nullif(partid, 0) as partid, createddate, duedate from history where v = 2 and productionorderid % 10 <> 7",
    "order_topic": f"""{HISTORY} select '{{"company":"' || split_part(db_name, '_', 3) || '","datasource":"' || case when db_name like 'mes_old_%' then 'OLD_MES' else 'NEW_MES' end || '","productionorderid":' || productionorderid || '}}' as key, count(*) as messages, max(orderquantity) as orderquantity from history group by 1""",
    "raw_to_live": "select * exclude (tbl_name, op, seq) replace (1000 * version as version) from fx_live",
    "ordered_workshop_line": "select company, workshop, linecode, sum(lotquantity) as report_qty, count(*) as record_cnt from fx_live group by all",
    "ordered_orders": f"select company, productionorder, max(orderquantity) as order_qty, sum(lotquantity) as report_qty, {rate('sum(lotquantity)', 'max(orderquantity)')} as achieve_rate from fx_live group by company, productionorder",
    "alert_counters": GAPS + "select 'MISSING_REPORT' as alert_type, level, count(*) as fired from history where level <> 'NONE' group by level",
    "reconcile_workshop_line": compared(f"select split_part(l.db_name, '_', 3) as company, n_name as workshop, s_name as linecode, sum(qty) as q from (select l.* from {LAST_LOT}) l left join supplier on s_suppkey = workcenterid left join nation on n_nationkey = s_nationkey group by all", "company, workshop, linecode"),
    "reconcile_order": compared(f"select split_part(l.db_name, '_', 3) as company, case when l.db_name like 'mes_old_%' then 'OLD_MES' else 'NEW_MES' end as datasource, productionorderno as productionorder, sum(qty) as q from {LAST_LOT} group by all", "company, datasource, productionorder"),
    "wide_roundtrip": "select company, shift_date, is_deleted, count(*) as records, sum(lotquantity) as qty from fx_wide group by all",
    "dirty_split": """select case when cast(record_id as bigint) % 97 = 1 then 'op' when cast(record_id as bigint) % 89 = 2 then 'required' when cast(record_id as bigint) % 83 = 3 then 'channel' when cast(record_id as bigint) % 79 = 4 then 'time' else 'ok' end as reason,
      count(*) as records from fx_log where tbl_name = 'lot' group by 1""",
    "latest_reports": "select db_name, tbl_name, record_id, op, version, qty, event_time from fx_last",
    "live_wide": "select * exclude (tbl_name, op, seq) from fx_live",
    "live_filter_first": "select company, outputtype, count(*) as records, sum(lotquantity) as qty from (select * from fx_counts where counts qualify row_number() over (partition by db_name, tbl_name, record_id order by version desc, seq desc) = 1) where not is_deleted group by all",
    "asof_order_join": """select l.record_id, l.version, case when version >= 4 and l.productionorderid % 10 = 7 then null else productionorderno end as productionorderno,
      case when version >= 4 and l.productionorderid % 10 = 7 then null when version >= 2 then 2 * orderquantity else orderquantity end as orderquantity from fx_log l join fx_order o on l.db_name = o.db_name and l.productionorderid = o.productionorderid""",
    "dim_miss_profile": """select outputtype, count(*) as records, count(*) filter (coalesce(productionorder, '') = '') as order_miss, count(*) filter (coalesce(partcode, '') = '') as part_miss, count(*) filter (coalesce(linecode, '') = '') as line_miss,
      count(*) filter (coalesce(workshop, '') = '') as workshop_miss, count(*) filter (coalesce(username, '') = '') as user_miss from fx_live group by outputtype""",
    "dim_miss_rows": "select l.db_name, record_id, version, partid from fx_log l join fx_order o on l.db_name = o.db_name and l.productionorderid = o.productionorderid where not exists (select 1 from part where p_partkey = partid)",
    "delete_audit": f"""select record_id, company, tbl_name as table_name, version as ts_ms,
      '{{"record_id":"' || record_id || '","company":"' || company || '","op":"d","tbl_name":"' || tbl_name || '","version":' || version || coalesce(',"productionorder":"' || productionorder || '"', '') || '}}' as payload, {NOW} as audit_time from fx_wide where op = 'd'""",
    "signed_deltas": "select record_id, version, qty_delta, cnt_delta, linecode, outputdatetime from fx_delta",
    "minute_output": MINUTES,
    "minute_salted": MINUTES,
    "minute_merge": MINUTES,
    "stream_minute_deltas": MINUTES,
    "recompute_minute": "select date_trunc('minute', outputdatetime) as ts_minute, company, workshop, linecode, partcode, min(linename) as linename, sum(lotquantity) as output_quantity, count(*) as record_cnt from fx_live group by all",
    "order_achievement": f"select shift_date, company, datasource, productionorder, report_quantity, order_quantity, {rate('report_quantity', 'order_quantity')} as achieve_rate, last_report_time from fx_shift",
    "plan_progress": ACHIEVED,
    "stream_orders": ACHIEVED,
    "dim_achievement": f""", attributed as (
      select shift_date, company, datasource, productionorder, max_by(workshop, (version, record_id)) as workshop, max_by(struct_pack(l := linecode), (version, record_id)).l as linecode, max(orderquantity) as q, sum(lotquantity) as r from fx_live group by shift_date, company, datasource, productionorder
    ), merged as (select company, workshop, linecode, datasource, productionorder, sum(r) as r, max(q) as q from attributed group by all)
    select company, workshop, linecode, sum(r) as report_qty, cast(sum(q) as bigint) as order_qty, {rate('sum(r)', 'cast(sum(q) as bigint)')} as achieve_rate from merged group by company, workshop, linecode""",
    "recompute_orders": f""", attributed as (
      select shift_date, company, datasource, productionorder, max_by(struct_pack(w := workshop, l := linecode, p := partcode), (version, record_id)) as a from fx_live group by shift_date, company, datasource, productionorder
    ) select a.w as workshop, a.l as linecode, a.p as partcode, shift_date, company, datasource, productionorder, productionorderid, order_quantity, report_quantity, {rate('report_quantity', 'order_quantity')} as achieve_rate, {progress('created', 'due', NOW)} as plan_progress, last_report_time,
      cast(epoch({NOW}) as bigint) * 1000 as version from fx_shift join attributed using (shift_date, company, datasource, productionorder)""",
    "recon_site_shift": "select company, shift_date, outputtype, sum(lotquantity) as report_qty, count(*) as record_cnt from fx_live where outputdatetime >= timestamp '1993-01-01' and outputdatetime < timestamp '1997-01-01' group by all",
    "recon_workshop_line": "select company, workshop, linecode, sum(lotquantity) as report_qty, count(*) as record_cnt from fx_live group by all",
    "recon_order": f"select company, datasource, productionorder, order_quantity as order_qty, report_quantity as report_qty, {rate('report_quantity', 'order_quantity')} as achieve_rate from fx_whole",
    "version_audit": "select record_id, count(*) as versions, min(version) as first_version, max(version) as last_version from fx_log group by record_id having count(*) > 1 order by versions desc, record_id limit 50",
    "baseline_manual_shift": f"select l.db_name, cast(event_time - interval 510 minutes as date) as shift_date, 'MANUAL' as channel, sum(qty) as report_qty, count(*) as record_cnt from {LAST_LOT} group by all",
    "baseline_lpn_shift": """select t.db_name, cast(scan_time - interval 510 minutes as date) as shift_date, 'BARCODE' as channel, cast(sum(t.qty) as bigint) as report_qty, count(*) as lpn_cnt
      from (select db_name, lpnbarcode, productionorderid, modelencode, model, users, sum(qty) as qty, max(event_time) as scan_time from fx_last where op <> 'd' and tbl_name = 'barcodeautomatic' group by all) t
      join fx_order o on t.db_name = o.db_name and t.productionorderid = o.productionorderid where t.qty > 0 and productionorderno not like 'FG%' group by all""",
    "baseline_workshop_line": f"select l.db_name, n_name as workshop, s_name as linecode, sum(qty) as report_qty, count(*) as record_cnt from (select l.* from {LAST_LOT}) l left join supplier on s_suppkey = workcenterid left join nation on n_nationkey = s_nationkey group by all",
    "baseline_order_rate": f"select l.db_name, productionorderno as productionorder, orderquantity as order_qty, sum(qty) as report_qty, {rate('sum(qty)', 'orderquantity')} as achieve_rate from {LAST_LOT} group by l.db_name, productionorderno, orderquantity",
    "reconcile_site_shift": f""", base as (select split_part(l.db_name, '_', 3) as company, cast(event_time - interval 510 minutes as date) as shift_date, sum(qty) as q from {LAST_LOT} group by all),
      result as (select company, shift_date, sum(lotquantity) as q from fx_live where outputtype = 'MANUAL' group by all)
      select company, shift_date, coalesce(b.q, 0) as baseline_qty, coalesce(r.q, 0) as result_qty, coalesce(r.q, 0) - coalesce(b.q, 0) as diff, abs(coalesce(r.q, 0) - coalesce(b.q, 0)) <= 0.005 * abs(coalesce(b.q, 0)) as within_tolerance from base b full join result r using (company, shift_date)""",
    "total_check": "select company, sum(m) as minute_qty, sum(d) as detail_qty from (select company, output_quantity as m, 0 as d from fx_minute union all select company, 0, lotquantity from fx_live) group by rollup (company)",
    "order_running_qty": "select record_id, shift_date, productionorder, running as running_qty from fx_run_shift",
    "over_report_alerts": f"""select 'OVER_REPORT:' || {ORDER_ALERT} as alert_id, 'OVER_REPORT' as alert_type, company, linecode, productionorder, orderquantity as order_quantity, running as report_quantity, {rate('running', 'orderquantity')} as achieve_rate,
      outputdatetime as alert_time, cast(null as timestamp) as recover_time from fx_run where orderquantity > 0 and running > orderquantity qualify row_number() over (partition by company, datasource, productionorder order by outputdatetime, record_id, outputtype) = 1""",
    "lag_alerts": flags("fx_run", "company, datasource, productionorder") + f"""select 'LAG:' || {ORDER_ALERT} as alert_id, 'LAG' as alert_type, company, linecode, productionorder, orderquantity as order_quantity, running as report_quantity,
      {rate('running', 'orderquantity')} as achieve_rate, outputdatetime as alert_time, until as recover_time from turns where lags""",
    "missing_report_alerts": GAPS + "select alert_id, company, linecode, alert_time, recover_time from gaps",
    "escalation_history": GAPS + "select alert_id, alert_time, step, level, changed, cast(epoch(changed) as bigint) * 1000 as version from history",
    "current_alerts": GAPS + "select 'MISSING_REPORT' as alert_type, alert_id, level, changed, alert_time from history qualify row_number() over (partition by alert_id order by changed desc, step desc, alert_time desc) = 1",
    "alert_totals": TOTALS + "select * from totals",
    "stream_alerts": TOTALS + "select * from totals where alert_type <> 'MISSING_REPORT'",
    "latest_alerts": f"""select 'OVER_REPORT:' || {ORDER_ALERT} as alert_id, outputdatetime as alert_time, running as report_quantity from (select * from fx_run_shift where orderquantity > 0 and running > orderquantity
      qualify row_number() over (partition by shift_date, company, datasource, productionorder order by outputdatetime, record_id, outputtype) = 1) order by alert_time desc, alert_id, report_quantity desc limit 10""",
    "alert_digest": GAPS + DIGEST + "select * from digest",
    "digest_rate_limit": GAPS + DIGEST + "select cast(date_trunc('month', flush) as timestamp) as bucket, flush, company, alert_type, row_number() over (partition by date_trunc('month', flush) order by flush, company, alert_type) <= 18 as sent from digest",
    "alert_messages": GAPS + "select company || ':' || linecode || ':' as key, count(*) as messages from gaps group by 1",
    "quality_profile": "select company, outputtype, count(*) as changes, count(*) filter (outputdatetime is null) as dirty, count(*) filter (is_deleted) as deleted, count(*) filter (not counts) as filtered, count(*) filter (productionorder is null) as order_miss from fx_counts group by all",
    "day_shift_share": "select company, count(*) as records, count(*) filter (hour(outputdatetime) * 60 + minute(outputdatetime) between 510 and 1050) as day_records from fx_live group by company",
}
BODIES["stream_live_wide"] = BODIES["live_wide"]
BODIES["stream_minute_keyed"] = MINUTES
BODIES["order_running_blocks"] = BODIES["order_running_qty"]
BODIES["stream_asof_orders"] = BODIES["asof_order_join"]
BODIES["stream_delete_audit"] = "select record_id, company, tbl_name as table_name, version as ts_ms from fx_wide where op = 'd'"
LEVELS = "select alert_id, alert_time, level, changed from history"
BODIES["stream_missing_report"] = GAPS + LEVELS
BODIES["stream_order_alerts"] = (
    flags("fx_run", "company, datasource, productionorder")
    + f""", raised as (
  select 'OVER_REPORT:' || {ORDER_ALERT} as alert_id, min(outputdatetime) as alert_time, cast(null as timestamp) as recover_time from fx_run where orderquantity > 0 and running > orderquantity group by 1
  union all select 'LAG:' || {ORDER_ALERT}, outputdatetime, until from turns where lags
)"""
    + stepped("raised", "alert_id")
    + LEVELS
)
SNAPSHOTS = f"""select * from (
with recursive at_times as (
  select distinct company, datasource, productionorder, outputdatetime as t from fx_live where productionorder is not null
), jumps as (
  select a.company, a.datasource, a.productionorder, a.t, min(b.t) as after from at_times a join at_times b on a.company = b.company and a.datasource = b.datasource and a.productionorder = b.productionorder and b.t > a.t + interval 5 days group by all
), begun as (
  select company, datasource, productionorder, min(t) as t from at_times group by all
  union all select b.company, b.datasource, b.productionorder, j.after from begun b join jumps j on b.company = j.company and b.datasource = j.datasource and b.productionorder = j.productionorder and b.t = j.t
)
select b.company, b.datasource, b.productionorder, max(orderquantity) as order_quantity, sum(lotquantity) as report_quantity, {rate('sum(lotquantity)', 'max(orderquantity)')} as achieve_rate,
  {progress('max(ordercreateddate)', 'max(orderduedate)', '(b.t + interval 5 days)')} as plan_progress, cast(epoch(b.t + interval 5 days) as bigint) * 1000 as version
from begun b join fx_live l on b.company = l.company and b.datasource = l.datasource and b.productionorder = l.productionorder and l.outputdatetime <= b.t + interval 5 days group by b.company, b.datasource, b.productionorder, b.t
)"""
BODIES["stream_order_snapshots"] = SNAPSHOTS

BODIES["reconcile_scan_shift"] = """, packages as (
  select l.company, l.db_name, lpnbarcode, productionorderid, modelencode, model, users, sum(qty) as q, cast(max(event_time) - interval 510 minutes as date) as shift_date
  from (select *, split_part(db_name, '_', 3) as company from fx_last) l where op <> 'd' and tbl_name = 'barcodeautomatic' group by l.company, l.db_name, lpnbarcode, productionorderid, modelencode, model, users having sum(qty) > 0
), known as (
  select p.*, productionorderno as productionorder from packages p join fx_order o on p.db_name = o.db_name and p.productionorderid = o.productionorderid where productionorderno not like 'FG%'
), sides as (
  select company, shift_date, q as b, 0 as r from known union all select company, shift_date, 0, lotquantity from fx_live where outputtype = 'BARCODE'
)
select company, shift_date, sum(b) as baseline_qty, sum(r) as result_qty, sum(r) - sum(b) as diff, abs(sum(r) - sum(b)) <= 0.005 * abs(sum(b)) as within_tolerance from sides group by company, shift_date"""
BODIES["reconcile_scan_packages"] = BODIES["reconcile_scan_shift"].split(", sides as")[0] + """, sides as (
  select company, shift_date, productionorder, lpnbarcode, q as b, 1 as bc, 0 as r, 0 as rc from known
  union all select company, shift_date, productionorder, lpnbarcode, 0, 0, sum(lotquantity), 1 from fx_live where outputtype = 'BARCODE' group by company, shift_date, productionorder, lpnbarcode
)
select company, shift_date, productionorder, lpnbarcode, sum(b) as baseline_qty, cast(sum(bc) as bigint) as baseline_cnt, sum(r) as result_qty, cast(sum(rc) as bigint) as result_cnt
from sides group by company, shift_date, productionorder, lpnbarcode having sum(b) <> sum(r) or sum(bc) <> sum(rc)"""
RECORDS = f""", sides as (
  select split_part(l.db_name, '_', 3) as company, s_name as linecode, productionorderno as productionorder, record_id, qty as b, 1 as bc, 0 as r, 0 as rc from (select l.*, o.productionorderno from {LAST_LOT}) l left join supplier on s_suppkey = workcenterid
  union all
  select company, linecode, productionorder, record_id, 0, 0, lotquantity, 1 from (select * from fx_counts where counts qualify row_number() over (partition by db_name, tbl_name, record_id order by version desc, seq desc) = 1) where not is_deleted and outputtype = 'MANUAL'
), differing as (
  select company, linecode, productionorder, record_id, sum(b) as baseline_qty, cast(sum(bc) as bigint) as baseline_cnt, sum(r) as result_qty, cast(sum(rc) as bigint) as result_cnt from sides group by all having sum(b) <> sum(r) or sum(bc) <> sum(rc)
)"""
BODIES["reconcile_records"] = RECORDS + " select * from differing"
BODIES["reconcile_tree"] = RECORDS + """, finest as (
  select company, linecode, productionorder, sum(b) as b, sum(bc) as bc, sum(r) as r, sum(rc) as rc from sides group by all
), marked as (
  select f.*, exists (select 1 from differing d where d.company is not distinct from f.company and d.linecode is not distinct from f.linecode and d.productionorder is not distinct from f.productionorder) as unequal from finest f
)
select 3 - grouping(company) - grouping(linecode) - grouping(productionorder) as level, company, linecode, productionorder, count(*) filter (unequal) as groups, sum(b) as baseline_qty, cast(sum(bc) as bigint) as baseline_cnt, sum(r) as result_qty, cast(sum(rc) as bigint) as result_cnt,
  abs(sum(r) - sum(b)) <= 0.005 * abs(sum(b)) as within_tolerance from marked group by rollup (company, linecode, productionorder) having count(*) filter (unequal) > 0"""
PARTED = f""", parted as (select *, least(version, 3) as part from fx_delta), clocks as (
  select p as part, (select max(outputdatetime) from fx_wide where least(version, 3) < p) as seen from range(1, 4) t(p)
), flagged as (
  select date_trunc('minute', outputdatetime) as ts_minute, company, workshop, linecode, partcode, linename, qty_delta, cnt_delta, part, coalesce(date_trunc('minute', outputdatetime) + interval 1 minute <= seen - to_seconds({360 * 86400}), false) as late_flag from parted join clocks using (part)
)"""
BODIES["stream_late_minutes"] = PARTED + """ select ts_minute, company, workshop, linecode, partcode, late_flag, min(linename) as linename, sum(qty_delta) as output_quantity, sum(cnt_delta) as record_cnt from flagged
  group by ts_minute, company, workshop, linecode, partcode, late_flag having sum(qty_delta) <> 0 or sum(cnt_delta) <> 0"""
BODIES["stream_late_counts"] = PARTED + " select part - 1 as batch_id, count(*) filter (late_flag) as late, count(*) filter (not late_flag) as in_time from flagged group by part"
BODIES["stream_replayed_log"] = "select coalesce(nullif(productionorder, ''), record_id) as key, count(*) as messages, count(distinct (db_name, tbl_name, record_id)) as records, sum(lotquantity) as qty from fx_wide group by 1"
MISSES = {"order_miss": "productionorder", "part_miss": "partcode", "line_miss": "linecode", "workshop_miss": "workshop", "user_miss": "username"}
BODIES["stream_metrics"] = (
    TOTALS.rsplit(", totals as", 1)[0]
    + f""", raised as (
  select 'OVER_REPORT' as kind, outputdatetime as alert_time, cast(null as timestamp) as recover_time from over_shift
  union all select 'LAG', outputdatetime, until from turns where lags
  union all select 'MISSING_REPORT', alert_time, recover_time from gaps
), kinds as (select kind, level from (values ('OVER_REPORT'), ('LAG'), ('MISSING_REPORT')) k(kind), (values ('P3'), ('P2'), ('P1')) l(level)), risen as (
  select kind, unnest(['P3', 'P2', 'P1'][1:1 + cast(least(2, greatest(0, (date_diff('second', alert_time, case when recover_time <= {NOW} then recover_time else {NOW} end) - case when recover_time <= {NOW} then 1 else 0 end) // {STEP})) as integer)]) as level
  from raised where alert_time <= {NOW}
)
select 'alert_fired.' || kind || '_' || level as metric, count(r.k) as value from kinds left join (select kind, level, 1 as k from risen) r using (kind, level) group by kind, level
union all select 'quality.changes', count(*) from fx_counts union all select 'quality.dirty', count(*) from fx_counts where outputdatetime is null
union all select 'quality.deleted', count(*) from fx_counts where is_deleted union all select 'quality.filtered', count(*) from fx_counts where not counts
"""
    + "\n".join(f"union all select 'dim_miss.{channel}_{name}', count(*) from fx_counts where outputtype = '{channel}' and coalesce({c}, '') = ''" for channel in ("MANUAL", "BARCODE") for name, c in MISSES.items())
)
BODIES["stream_digest_limit"] = GAPS + DIGEST + """ select * from (
with recursive queued as materialized (
  select flush, company, alert_type, row_number() over (order by flush, company, alert_type) as n from digest
), replayed as (
  select cast(0 as bigint) as n, cast([] as timestamp[]) as held, false as sent
  union all
  select q.n, case when len(list_filter(held, lambda t: q.flush - interval 30 days <= t)) < 18 then list_append(list_filter(held, lambda t: q.flush - interval 30 days <= t), q.flush) else list_filter(held, lambda t: q.flush - interval 30 days <= t) end,
    len(list_filter(held, lambda t: q.flush - interval 30 days <= t)) < 18
  from replayed r join queued q on q.n = r.n + 1
)
select company, alert_type, flush, sent from replayed join queued using (n))"""

BODIES["shift_windows"] = "select cast(cast(event_time - interval 510 minutes as date) as timestamp) + interval 510 minutes as shift_start, count(*) as changes, 0 as differing from fx_log group by 1"
BODIES["parsed_times"] = "select productionorderid, case when productionorderid % 4 < 3 then createddate end as parsed, case when productionorderid % 4 < 3 then epoch_ms(createddate) else 0 end as ms from fx_order"
RAISED = (
    TOTALS.rsplit(", totals as", 1)[0]
    + """, raised as (
  select 'OVER_REPORT' as alert_type, outputdatetime as alert_time, cast(null as timestamp) as recover_time from over_shift
  union all select 'LAG', outputdatetime, until from turns where lags
  union all select 'MISSING_REPORT', alert_time, recover_time from gaps
)"""
)
BODIES["next_levels"] = RAISED + stepped("raised", "alert_type").replace("stepped as", "all_steps as").replace("from stepped", "from all_steps").replace("history as", "levels as") + """
select alert_type, level, case level when 'NONE' then 'P3' when 'P3' then 'P2' else 'P1' end as next_level, count(*) as alerts from levels group by alert_type, level"""
BODIES["datasource_parity"] = """select case when productionorderid % 7 = 0 then 'x_' || db_name else db_name end as db_name,
  case when productionorderid % 7 = 0 then null when db_name like 'mes_old_%' then 'OLD_MES' else 'NEW_MES' end as datasource,
  case when productionorderid % 7 <> 0 and db_name like 'mes_old_%' then 'OLD_MES' else 'NEW_MES' end as datasource_sql, count(*) as changes from fx_log group by all"""
BODIES["digest_messages"] = GAPS + DIGEST + """, told as (
  select flush, company, items, '[' || level || '] MISSING_REPORT - ' || company || case when items > 1 then '（共 ' || items || ' 条）' else '' end as title from digest
), named as (
  select date_trunc('day', changed) as flush, company, array_to_string(list_sort(list_distinct(list(linecode)))[1:20], '、') as names from history where level <> 'NONE' group by 1, 2
)
select cast(t.flush as timestamp) as flush, t.company, 'MISSING_REPORT' as alert_type, items,
  '{"msgtype":"markdown","markdown":{"title":"' || title || '","text":"#### ' || title || '\\n- 产线：' || names || case when items > 20 then ' 等 ' || items || ' 项' else '' end || '\\n"}}' as message
from told t join named n on t.flush = n.flush and t.company = n.company"""
TEXTS = ("productionorder", "lpnbarcode", "username", "partcode", "partname", "linecode", "linename", "workcentertype", "workshop")
BODIES["stream_raw_wide"] = "select * exclude (tbl_name, op, seq) replace (1000 * version as version, " + ", ".join(f"coalesce({c}, '') as {c}" for c in TEXTS) + ") from fx_live"
BODIES["stream_raw_audit"] = "select company, tbl_name as table_name, count(*) as deleted, count(*) as messages from fx_wide where op = 'd' group by all"
BODIES["stream_dirty_lines"] = """select least(seq, 3) - 1 as batch_id, case when cast(record_id as bigint) % 97 = 1 and op = 'c' then 'op' when cast(record_id as bigint) % 83 = 3 then 'channel'
    when cast(record_id as bigint) % 79 = 4 and (op = 'c' or op = 'd' and version = 2) then 'time' else 'ok' end as reason, count(*) as records from fx_log group by all"""
BODIES["stream_minute_images"] = MINUTES
BODIES["stream_refreshed_dims"] = "select db_name, record_id, version, case when db_name <> 'mes_new_cq' then linename || ' v' || least(version, 2) end as linename, orderquantity + 1 as orderquantity from fx_wide"
BODIES["stream_alert_topic"] = GAPS + "select company || ':' || linecode || ':' as key, level, count(*) as messages from history group by all"
BODIES["stream_alert_digest"] = GAPS + DIGEST + "select flush, company, alert_type, alerts from digest"
BODIES["stream_windowed_minutes"] = "select date_trunc('minute', outputdatetime) as ts_minute, company, linecode, sum(lotquantity) as output_quantity, count(*) as record_cnt from fx_live group by all"

ORACLES = {name: INPUTS + body for name, body in BODIES.items()}
