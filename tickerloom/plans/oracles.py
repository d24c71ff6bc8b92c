"""The registered queries as plain SQL, for a second engine to check against.

Each text stands alone: it begins with the CTEs it needs and reads the given tables.
"""

from __future__ import annotations

_CELLS = "open, high, low, close, per_change, traded_quantity, traded_amount"

_CTES = {
    "bars": """
select user_id as uid, concat('U', cast(user_id as varchar)) as symbol, cast(ts as date) as d,
       min_by(value, ts) as open, max(value) as high, min(value) as low,
       max_by(value, ts) as close,
       cast(count(*) as double) as traded_quantity,
       cast(sum(cast(value as decimal(18,2))) as double) as traded_amount
from events group by 1, 2, 3""",
    "panel": """
select *, (close - lag(close) over (partition by symbol order by d))
          / lag(close) over (partition by symbol order by d) * 100 as per_change
from bars""",
    "dirty": f"""
select uid, symbol,
       case when uid % 50 = 11 and day(d) = 9 then 'not-a-date' else cast(d as varchar) end
         as published_date,
       case when uid % 20 = 3 and day(d) = 13 then null
            when uid % 20 = 4 and day(d) = 14 then cast(0 as double) else open end as open,
       high, low,
       case when uid % 20 = 5 and day(d) = 15 then cast('NaN' as double)
            when uid % 20 = 6 and day(d) = 16 then cast(-1 as double) else close end as close,
       case when uid % 20 = 7 and day(d) = 17 then cast('Infinity' as double)
            else per_change end as per_change,
       traded_quantity, traded_amount
from panel""",
    "raw": f"""
select symbol, published_date, {_CELLS} from dirty
union all
select symbol, published_date, {_CELLS} from dirty where uid % 50 = 0""",
    "uniq": "select distinct * from raw",
}


def _finite(source: str, date: str = "published_date") -> str:
    cells = ", ".join(
        f"case when isnan({name}) or abs({name}) = cast('Infinity' as double) "
        f"then null else {name} end as {name}"
        for name in _CELLS.split(", ")
    )
    return f"select symbol, {date} as published_date, {cells} from {source}"


_CTES["fin"] = _finite("uniq", "try_cast(published_date as date)")
_CTES["clean"] = """
select symbol, published_date, open, high, low, close,
       coalesce(per_change, cast(0 as double)) as per_change, traded_quantity, traded_amount
from fin
where published_date is not null and symbol is not null
  and traded_quantity is not null and traded_amount is not null
  and open > 0 and high > 0 and low > 0 and close > 0"""
_CTES["feat"] = """
select *, high - low as price_range, (close - open) / open as daily_return,
       lead(close) over (partition by symbol order by published_date) as next_close
from clean"""
_CTES["processed"] = """
select *, cast(case when next_close > close then 1 else 0 end as int) as target
from feat where next_close is not null"""
_CTES["history"] = """
select symbol, d as published_date, open, close, traded_quantity
from panel where d < date '2024-01-15'"""
_CTES["delivery"] = """
select symbol, d as published_date, open, close + 1 as close, traded_quantity from panel"""
_CTES["cells"] = """
select cast(count(*) filter (where quality = 1 and toxic = 1) as bigint) as tp,
       cast(count(*) filter (where quality <> 1 and toxic = 1) as bigint) as fp,
       cast(count(*) filter (where quality = 1 and toxic <> 1) as bigint) as fn,
       cast(count(*) filter (where quality <> 1 and toxic <> 1) as bigint) as tn
from labels"""
_CTES["scores"] = """
select *,
       case when tp + fp + fn + tn = 0 then 0.0 else (tp + tn) / (tp + fp + fn + tn) end
         as accuracy,
       case when tp + fp = 0 then 0.0 else tp / (tp + fp) end as "precision",
       case when tp + fn = 0 then 0.0 else tp / (tp + fn) end as recall
from cells"""
_CTES["per_label"] = """
select label, support, hits,
       case when predicted = 0 then cast(0 as double) else hits / predicted end as "precision",
       case when support = 0 then cast(0 as double) else hits / support end as recall
from (select label, sum(support) as support, sum(predicted) as predicted, sum(hits) as hits
      from (select quality as label, 1 as support, 0 as predicted,
                   case when quality = toxic then 1 else 0 end as hits from labels
            union all
            select toxic, 0, 1, 0 from labels)
      group by label)"""
_CTES["f1s"] = """
select *, case when "precision" + recall = 0 then cast(0 as double)
               else 2 * "precision" * recall / ("precision" + recall) end as f1
from per_label"""
_CTES["sizes"] = "select target, count(*) as n from processed group by target"
_CTES["shares"] = """
select target, n, n_train, n * n_train // n_all as whole, n * n_train % n_all as rest,
       n_train - sum(n * n_train // n_all) over () as spare
from (select target, cast(n as hugeint) as n, cast(sum(n) over () as hugeint) as n_all,
             cast(sum(n) over () - (sum(n) over () * 20 + 99) // 100 as hugeint) as n_train
      from sizes)"""
_CTES["quotas"] = """
select target, n - whole - case when row_number() over (order by rest desc, target) <= spare
                                then 1 else 0 end as need
from shares"""

_NEEDS = {
    "panel": ["bars"],
    "dirty": ["panel"],
    "raw": ["dirty"],
    "uniq": ["raw"],
    "fin": ["uniq"],
    "clean": ["fin"],
    "feat": ["clean"],
    "processed": ["feat"],
    "history": ["panel"],
    "delivery": ["panel"],
    "scores": ["cells"],
    "f1s": ["per_label"],
    "sizes": ["processed"],
    "shares": ["sizes"],
    "quotas": ["shares"],
}


def _with(names: str, body: str) -> str:
    """``body`` behind the named CTEs and those they need."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in names.split():
        add(name)
    if not order:
        return body
    return "with " + ",\n".join(f"{name} as ({_CTES[name]})" for name in order) + "\n" + body


_RAW_COLUMNS = ["symbol", "published_date", *_CELLS.split(", ")]


def _gaps(name: str) -> str:
    if name in ("symbol", "published_date"):
        return f"{name} is null"
    return f"{name} is null or isnan({name})"


_PROFILE = "\nunion all\n".join(
    f"select '{name}' as column_name, cast(count(*) filter (where {_gaps(name)}) as bigint) "
    f"as missing, cast(count(*) as bigint) as row_count, "
    f"cast({len(_RAW_COLUMNS)} as bigint) as column_count from raw"
    for name in _RAW_COLUMNS
)
_SUMMARY = "\nunion all\n".join(
    f"select cast({i} as int) as position, '{name}' as column_name, "
    f"'{'string' if i < 2 else 'double'}' as data_type, "
    f"cast(count(*) filter (where not ({_gaps(name)})) as bigint) as non_null from raw"
    for i, name in enumerate(_RAW_COLUMNS)
)

_APPENDED = """
select * from history
union all
select * from delivery n
where not exists (select 1 from history h
                  where h.symbol = n.symbol and h.published_date = n.published_date)"""

ORACLES: dict[str, str] = {
    "processed": _with("processed", "select * from processed"),
    "dedupe_rows": _with("uniq", _finite("uniq")),
    "nonfinite_to_null": _with("raw", _finite("raw")),
    "parse_dates": _with("raw", _finite("raw", "try_cast(published_date as date)")),
    "fill_change": _with(
        "fin",
        "select symbol, published_date, open, high, low, close, "
        "coalesce(per_change, cast(0 as double)) as per_change, traded_quantity, traded_amount "
        "from fin",
    ),
    "drop_incomplete": _with(
        "fin",
        "select * from fin where published_date is not null and symbol is not null "
        "and open is not null and high is not null and low is not null and close is not null "
        "and traded_quantity is not null and traded_amount is not null",
    ),
    "positive_prices": _with(
        "fin", "select * from fin where open > 0 and high > 0 and low > 0 and close > 0"
    ),
    "normalize_columns": "select s_suppkey, s_name, s_nationkey as snationkey, s_acctbal "
    "from supplier",
    "features": _with("feat", "select * exclude (next_close) from feat"),
    "label_next_up": _with(
        "processed", "select * exclude (price_range, daily_return) from processed"
    ),
    "label_skewed": _with(
        "clean",
        "select *, cast(case when next_close > close then 1 else 0 end as int) as target from ("
        "select *, lead(close) over (order by published_date) as next_close from ("
        "select * replace ('ALL' as symbol, "
        "published_date + cast(substr(symbol, 2) as int) * 400 as published_date) from clean)) "
        "where next_close is not null",
    ),
    "movement_label": _with(
        "fin",
        "select *, case when close > open then 'up' when close < open then 'down' "
        "else 'same' end as movement from fin",
    ),
    "feature_matrix": _with(
        "processed",
        "select open, high, low, close, per_change, traded_quantity, traded_amount, price_range, "
        "daily_return, target from processed",
    ),
    "flatten_lists": """
select vec_id, cast(position - 1 as int) as position, cast(flat[position] as double) as item
from (select vec_id, flat, unnest(range(1, len(flat) + 1)) as position
      from (select vec_id,
                   flatten([embedding[i * 4 + 1 : i * 4 + 4]
                            for i in range(0, (len(embedding) + 3) // 4)]) as flat
            from embeddings))""",
    "sorted_panel": _with(
        "clean",
        "select *, cast(row_number() over (order by symbol, published_date) - 1 as bigint) "
        "as position from clean",
    ),
    "first_n": _with("clean", "select * from clean order by symbol, published_date limit 100"),
    "first_per_symbol": _with(
        "clean",
        "select * from clean qualify row_number() over "
        "(partition by symbol order by published_date) = 1",
    ),
    "union_by_name": """
select event_id, user_id, value, cast(null as varchar) as event_type from events
union all
select event_id, cast(null as bigint), value, event_type from events""",
    "sector_join": """
select s_nationkey, s_suppkey, s_name, s_acctbal, n_name, n_regionkey
from supplier left join nation on s_nationkey = n_nationkey""",
    "pending_companies": _with(
        "raw",
        "select concat('U', cast(c_custkey as varchar)) as symbol, c_custkey as company_id "
        "from customer where concat('U', cast(c_custkey as varchar)) not in "
        "(select symbol from raw)",
    ),
    "append_new_rows": _with("history delivery", _APPENDED),
    "stream_daily_append": _with("history delivery", _APPENDED),
    "replayed_append": _with("history delivery", _APPENDED),
    "bounded_append": _with("panel", "select symbol, d as published_date, close from panel"),
    "distinct_by_sketch": _with(
        "fin",
        "select cast(date_trunc('week', published_date) as date) as span, "
        "cast(count(distinct symbol) as bigint) as companies, true as within_bound "
        "from fin where published_date is not null group by 1",
    ),
    "vote_dates": _with("fin", "select * from fin"),
    "first_n_wide": _with("clean", "select * from clean order by symbol, published_date limit 3000"),
    "restart_one_company": _with(
        "raw",
        "select symbol, cast((n + least(n, 50)) * case when number % 5 = 2 or number % 10 = 3 then 2 "
        "else 1 end as bigint) as staged, number % 10 = 3 as restarted from (select symbol, "
        "cast(substr(symbol, 2) as bigint) as number, count(*) as n from raw group by symbol)",
    ),
    "profile": _with("raw", _PROFILE),
    "column_summary": _with("raw", _SUMMARY),
    "merge_audit": _with(
        "raw uniq",
        "select cast((select count(*) from raw) as bigint) as rows_before, "
        "cast((select count(*) from raw) - (select count(*) from uniq) as bigint) as removed, "
        "cast((select count(*) from uniq) as bigint) as final_rows, "
        "cast((select count(distinct symbol) from raw) as bigint) as companies",
    ),
    "rows_per_symbol": _with(
        "raw uniq",
        "select symbol, cast(row_count as bigint) as row_count, "
        "cast(distinct_rows as bigint) as distinct_rows "
        "from (select symbol, count(*) as row_count from raw group by symbol) "
        "join (select symbol, count(*) as distinct_rows from uniq group by symbol) "
        "using (symbol)",
    ),
    "confusion": "select quality as truth, toxic as prediction, cast(count(*) as bigint) as n "
    "from labels group by 1, 2",
    "binary_metrics": _with(
        "scores",
        'select tp, fp, fn, tn, accuracy, "precision", recall, '
        'case when "precision" + recall = 0 then 0.0 '
        'else 2 * "precision" * recall / ("precision" + recall) end as f1 from scores',
    ),
    "classification_report": _with(
        "f1s",
        """
select cast(label as varchar) as section, "precision", recall, f1,
       cast(support as bigint) as support from f1s
union all
select 'accuracy', null, null, sum(hits) / sum(support), cast(sum(support) as bigint) from f1s
union all
select 'macro avg', avg("precision"), avg(recall), avg(f1), cast(sum(support) as bigint) from f1s
union all
select 'weighted avg', sum("precision" * support) / sum(support),
       sum(recall * support) / sum(support), sum(f1 * support) / sum(support),
       cast(sum(support) as bigint) from f1s""",
    ),
    "stratified_split": _with(
        "processed quotas",
        "select symbol, published_date, close, target, "
        "row_number() over (partition by target order by md5(concat_ws('|', symbol, "
        "cast(published_date as varchar), '42'))) <= need as is_test "
        "from processed join quotas using (target)",
    ),
    "split_by_date": _with(
        "processed",
        "select symbol, published_date, close, target, "
        "published_date >= date '2024-01-24' as is_test from processed",
    ),
    "table_scan": "select * from orders",
    "named_dataset_roundtrip": "select * from orders",
    "merged_csv_roundtrip": _with("uniq", _finite("uniq")),
    "scan_company_files": _with("raw", _finite("raw")),
    "incremental_scan": _with("raw", _finite("raw")),
    "scan_undated_files": _with(
        "raw",
        """
select *, row_number() over (order by symbol, published_date nulls last, open nulls first,
    high nulls first, low nulls first, close nulls first, per_change nulls first,
    traded_quantity nulls first, traded_amount nulls first) - 1 as position
from (select * replace (case when cast(substr(symbol, 2) as bigint) % 3 = 1 then null
                        else published_date end as published_date)
      from (""" + _finite("raw") + """))""",
    ),
    "page_explode": _with("raw", _finite("raw")),
    # A first page without data loses 40 rows: the next page brings its last ten again.
    "page_completeness": _with(
        "raw",
        """
select symbol, announced, landed, greatest(announced - landed, 0) as missing
from (select symbol,
             cast(case when any_value(number) % 11 = 5 then 0 else any_value(total) end as bigint)
               as announced,
             cast(count(distinct case when number % 7 = 3 and place <= 40
                                      then null else cells end) as bigint) as landed
      from (select symbol, cast(substr(symbol, 2) as bigint) as number,
                   count(*) over (partition by symbol) as total,
                   row_number() over (partition by symbol order by published_date,
                                      open nulls first, high, low, close) as place,
                   cast(row(published_date, open, high, low, close, per_change, traded_quantity,
                            traded_amount) as varchar) as cells
            from raw)
      group by symbol)""",
    ),
    "page_quarantine": _with(
        "dirty uniq",
        """
select 'not a page' as reason, cast(count(*) as bigint) as lines
from (select distinct symbol, (place - 1) // 50 as page
      from (select symbol, row_number() over (partition by symbol) as place from raw
            where cast(substr(symbol, 2) as bigint) % 13 = 4))
having count(*) > 0
union all
select 'not a number', cast(count(*) as bigint) from uniq
where cast(substr(symbol, 2) as bigint) % 13 <> 4
  and cast(substr(symbol, 2) as bigint) % 20 = 8 and published_date like '%-18'
having count(*) > 0""",
    ),
    "two_page_cycles": _with("uniq", _finite("uniq")),
    "file_audit": _with(
        "raw",
        "select cast(count(distinct symbol) + 1 as bigint) as files_found, "
        "cast(count(distinct symbol) as bigint) as files_valid, "
        "cast(count(*) as bigint) as lines_used, cast(0 as bigint) as lines_set_aside from raw",
    ),
    "forest_checks": _with(
        "quotas sizes",
        "select target as label, cast(n - need as bigint) as train_rows, "
        "cast(need as bigint) as test_rows, cast((select sum(need) from quotas) as bigint) "
        "as scored, true as accurate from sizes join quotas using (target)",
    ),
    "stream_page_load": _with("uniq", _finite("uniq")),
}

# Four digits for the scores, two for the table, cells of ten places.
ORACLES["report_text"] = f"""
with scores as ({ORACLES["binary_metrics"]}), report as ({ORACLES["classification_report"]}),
lines as (
  select 0 as line_no, 'Model Evaluation Report' as line
  union all select 1, repeat('=', 23)
  union all select 3, 'target 1: the next close is above this close; target 0: it is not'
  union all select 5, 'Accuracy  : ' || printf('%.4f', cast(accuracy as double)) from scores
  union all select 6, 'Precision : ' || printf('%.4f', cast("precision" as double)) from scores
  union all select 7, 'Recall    : ' || printf('%.4f', cast(recall as double)) from scores
  union all select 8, 'F1        : ' || printf('%.4f', cast(f1 as double)) from scores
  union all select 10, repeat(' ', 13) || ' precision    recall  f1-score   support'
  union all
  select case section when '0' then 12 when '1' then 13 when 'macro avg' then 16 else 17 end,
    lpad(section, 12, ' ') || ' ' || printf('%10.2f', cast("precision" as double))
    || printf('%10.2f', cast(recall as double)) || printf('%10.2f', cast(f1 as double))
    || lpad(cast(support as varchar), 10, ' ')
  from report where section <> 'accuracy'
  union all
  select 15, lpad(section, 12, ' ') || repeat(' ', 21) || printf('%10.2f', cast(f1 as double))
    || lpad(cast(support as varchar), 10, ' ') from report where section = 'accuracy'
  union all select unnest([2, 4, 9, 11, 14]), ''
)
select cast(line_no as integer) as line_no, line from lines"""
ORACLES["guarded_run"] = ORACLES["scan_company_files"]
