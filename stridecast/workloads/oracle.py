"""The same results in SQL, over the same tables.

Money is summed as decimal on both sides, means are rounded alike, and a zero
divisor gives null.
"""

from __future__ import annotations

_FOLD_DAYS = "(values (0, 0, 7), (1, 8, 14), (2, 15, 32), (3, 33, 45), (4, 46, 63), (5, 64, null))"

# Test rows of the orders with their fold, by range join on the calendar.
_FOLDS = f"""
calendar as (
    select fold, date '2001-01-01' + a as start_date,
           case when b is null then cast(last_day(date '2001-01-01' + interval 5 month) as date)
                else date '2001-01-01' + b end as end_date
    from {_FOLD_DAYS} t(fold, a, b)
),
folded as (
    select o.*, cast(o.o_orderdate as date) as d, c.fold
    from orders o join calendar c on cast(o.o_orderdate as date) between c.start_date and c.end_date
)
"""

_SALES = """
sales as (
    select l_orderkey, l_linenumber, p_type, l_shipdate,
           strftime(l_shipdate, '%Y-%m') as ship_month,
           cast(l_extendedprice as decimal(18,2)) as t,
           cast(l_quantity * p_retailprice as decimal(18,2)) as p
    from lineitem join part on l_partkey = p_partkey
),
scored as (
    select *, cast(t as double) as td, cast(p as double) as pd,
           abs((cast(t as double) - cast(p as double)) / nullif(cast(t as double), 0) * 100) as ape,
           abs(cast(t as double) - cast(p as double)) as ae
    from sales
)
"""


def _levels(sets: str) -> str:
    return f"""
    select p_type, ship_month, level, sum_target, sum_prediction, row_count,
           abs(sum_target - sum_prediction) as abs_error,
           abs((sum_target - sum_prediction) / nullif(sum_target, 0) * 100) as abs_perc_error
    from (
        select p_type, ship_month, cast(grouping(p_type, ship_month) as bigint) as level,
               cast(sum(t) as double) as sum_target,
               cast(sum(p) as double) as sum_prediction,
               count(*) as row_count
        from sales group by grouping sets ({sets})
    )
    """


_ALL_SETS = "(p_type, ship_month), (p_type), (ship_month)"

_HISTORY = """
lines as (
    select l_orderkey, cast(count(*) as double) as line_count,
           cast(sum(cast(l_quantity as decimal(18,2))) as double) as quantity,
           cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as gross
    from lineitem group by l_orderkey
),
history as (
    select o.*, cast(o_orderdate as date) as d, line_count, quantity, gross
    from orders o left join lines on l_orderkey = o_orderkey
)
"""

_RANKS = """
{name} as (
    select {column} as label, row_number() over (order by count(*) desc, {column}) - 1 as i
    from orders where o_orderdate < timestamp '2001-01-01'{more} group by 1
)
"""


def _slots(column: str, prefix: str, size: int, first: int = 0) -> str:
    return ", ".join(
        f"cast(coalesce({column}, {size - 1}) = {i} as double) as {prefix}{first + i}"
        for i in range(size)
    )


# The best single split on flags, per fold and variant. Of all flags a model has, that
# with the largest sum of squared side totals over side counts reduces the variance most.
_STUMP = f"""
{_HISTORY},
flagged as (
    select o_orderkey, d, o_orderpriority as label, o_totalprice as t, d < date '2001-01-01' as past,
           line_count >= 5 as many, quantity >= 100 as bulky, gross >= 200000 as dear
    from history
),
training as (
    select 'full' as variant, * from flagged where past and many is not null
    union all select 'basic', * from flagged where past
),
labels as (
    select variant, label as name, row_number() over (partition by variant order by count(*) desc, label) - 1 as i
    from training group by 1, 2
),
flags as (
    select variant, 'many' as feature, 0 as place, many as flag, t from training where variant = 'full'
    union all select variant, 'bulky', 1, bulky, t from training where variant = 'full'
    union all select variant, 'dear', 2, dear, t from training where variant = 'full'
    union all select variant, name, 3 + i, label = name, t from training join labels using (variant)
),
sides as (
    select variant, feature, place,
           count(*) filter (where flag) as n1,
           sum(cast(t as decimal(18,2))) filter (where flag)::double as s1,
           count(*) filter (where not flag) as n0,
           sum(cast(t as decimal(18,2))) filter (where not flag)::double as s0
    from flags group by 1, 2, 3
),
folds(fold, own) as (values (0, 3), (1, 3), (2, 2), (3, 2), (4, 1), (5, 1)),
ranked as (
    select *, row_number() over (
               partition by fold, variant order by s1 * s1 / n1 + s0 * s0 / n0 desc, place) as choice
    from sides cross join folds
    where (place < own or place >= 3) and n1 > 0 and n0 > 0
),
chosen as (
    select fold, variant, feature, s1 / n1 as mean1, s0 / n0 as mean0 from ranked where choice = 1
)
"""

# The folds of 2001-01-10 up to the month's end.
_SHORT = """
    select o_orderkey, cast(o_orderdate as date) as o_orderdate,
           case when o_orderdate < timestamp '2001-01-18' then 0
                when o_orderdate < timestamp '2001-01-25' then 1 else 2 end as fold
    from orders
    where o_orderdate >= timestamp '2001-01-10' and o_orderdate < timestamp '2001-02-01'
"""

_FLAG = """case feature when 'many' then many when 'bulky' then bulky when 'dear' then dear
               else label = feature end"""

ORACLE_SQL = {
    "error_cols": """
        select l_orderkey, l_linenumber, l_discount, l_tax,
               abs((l_discount - l_tax) / nullif(l_discount, 0) * 100) as "l_discount_APE",
               abs(l_discount - l_tax) as "l_discount_AE",
               (l_discount - l_tax) * (l_discount - l_tax) as "l_discount_SE"
        from lineitem
    """,
    "eval_rows": f"""
        with {_SALES}
        select l_orderkey, l_linenumber, p_type, cast(l_shipdate as date) as l_shipdate,
               td as revenue, pd as revenue_pred, ape as "revenue_APE", ae as "revenue_AE"
        from scored where l_shipdate >= timestamp '2000-01-01'
    """,
    "eval_levels": f"with {_SALES} {_levels(_ALL_SETS)}",
    "eval_levels_basic": f"with {_SALES} {_levels('(p_type, ship_month)')}",
    "eval_summary": f"""
        with {_SALES}, levels as ({_levels(_ALL_SETS)}),
        per_level as (
            select case level when 0 then 'p_type,ship_month' when 1 then 'p_type'
                              else 'ship_month' end as scope,
                   avg(abs_perc_error) as mape, avg(abs_error) as mae
            from levels group by 1
        ),
        per_row as (
            select avg(ape) as mape, avg(ae) as mae,
                   100.0 * count(*) filter (where ape > 50) / nullif(count(*), 0) as o50,
                   100.0 * count(*) filter (where ape > 100) / nullif(count(*), 0) as o100
            from scored
        )
        select scope, metric, round(cast(value as double), 6) as value from (
            select scope, 'mape' as metric, mape as value from per_level
            union all select scope, 'mae', mae from per_level
            union all select 'rows', 'mape', mape from per_row
            union all select 'rows', 'mae', mae from per_row
            union all select 'rows', 'outliers_50', o50 from per_row
            union all select 'rows', 'outliers_100', o100 from per_row
        )
    """,
    "outlier_share": f"""
        with {_SALES}
        select count(*) as row_count,
               cast(count(*) filter (where ape > 50) as double) * 100
                   / nullif(cast(count(*) as double), 0) as outliers_50,
               cast(count(*) filter (where ape > 100) as double) * 100
                   / nullif(cast(count(*) as double), 0) as outliers_100
        from scored
    """,
    "error_means": f"""
        with {_FOLDS}, {_HISTORY},
        tagged as (
            select h.*, f.fold from history h left join folded f using (o_orderkey)
            where h.o_orderdate < timestamp '2001-01-01' or f.fold is not null
        )
        select fold, quantity is null as is_basic,
               round(avg(abs((o_totalprice - gross) / nullif(o_totalprice, 0) * 100)), 6) as mape,
               round(avg(abs(o_totalprice - gross)), 6) as mae,
               count(o_orderkey) as row_count
        from tagged group by 1, 2
    """,
    "fold_calendar": f"""
        with days as (select distinct cast(o_orderdate as date) as split_date from orders)
        select split_date, fold, split_date + a as start_date,
               case when b is null then cast(last_day(split_date + interval 5 month) as date)
                    else split_date + b end as end_date
        from days cross join {_FOLD_DAYS} t(fold, a, b)
    """,
    "fold_assign": f"with {_FOLDS} select o_orderkey, d as o_orderdate, fold from folded",
    "fold_assign_months": f"""
        with splits as (
            select distinct cast(date_trunc('month', o_orderdate) as date) as split_date from orders
        ),
        starts as (
            select split_date, fold, split_date + a as first_day,
                   case when b is null then cast(last_day(split_date + interval 5 month) as date)
                        else split_date + b end as final_day
            from splits cross join {_FOLD_DAYS} t(fold, a, b)
        )
        select o_orderkey, cast(o_orderdate as date) as o_orderdate, split_date, fold
        from orders join starts on cast(o_orderdate as date) between first_day and final_day
    """,
    "fold_counts_daily": f"""
        with splits as (select distinct cast(o_orderdate as date) as split_date from orders),
        starts as (
            select split_date, fold, split_date + a as first_day,
                   least(coalesce(split_date + b, date '9999-12-31'),
                         cast(last_day(split_date + interval 1 month) as date)) as final_day
            from splits cross join {_FOLD_DAYS} t(fold, a, b)
        ),
        daily as (
            select cast(o_orderdate as date) as d, count(*) as n,
                   sum(cast(o_totalprice as decimal(18,2))) as price
            from orders group by 1
        )
        select split_date, fold, cast(sum(n) as bigint) as row_count, cast(sum(price) as double) as total
        from daily join starts on d between first_day and final_day group by all
    """,
    "fold_assign_short": _SHORT,
    "fold_calendar_short": _SHORT,
    "fold_assign_timestamps": """
        select event_id, user_id,
               case when cast(ts as date) <= date '2024-01-08' then 0
                    when cast(ts as date) <= date '2024-01-15' then 1 else 2 end as fold
        from events
        where cast(ts as date) between date '2024-01-01' and date '2024-01-31'
    """,
    "train_cut": """
        select o_orderkey, o_totalprice, cast(o_orderdate as date) as o_orderdate
        from orders where o_orderdate < timestamp '2001-01-01'
    """,
    "train_test_split": f"""
        with {_FOLDS}
        select o_orderkey, 'train' as role, cast(null as integer) as fold
        from orders where o_orderdate < timestamp '2001-01-01'
        union all select o_orderkey, 'test', fold from folded
    """,
    "split_fold_frames": f"""
        with {_FOLDS}
        select 'train' as role, fold, count(*) as row_count,
               cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total,
               cast(sum(fold) as bigint) as scale
        from orders cross join calendar
        where o_orderdate < timestamp '2001-01-01'
          and substr(md5(concat(cast(o_orderkey as varchar), '#23')), 1, 8) < '80000000'
        group by fold
        union all
        select 'test', fold, count(*),
               cast(sum(cast(o_totalprice as decimal(18,2))) as double), cast(sum(fold) as bigint)
        from folded group by fold
    """,
    "sample_fraction": """
        select o_orderkey from orders
        where substr(md5(concat(cast(o_orderkey as varchar), '#23')), 1, 8) < '4ccccccc'
    """,
    "sample_count": """
        select o_orderkey, o_totalprice from orders where o_orderdate < timestamp '2001-01-01'
        order by md5(concat(cast(o_orderkey as varchar), '#23')) limit 5000
    """,
    "feature_projection": f"""
        with {_HISTORY}
        select o_orderkey, o_custkey, d as o_orderdate, o_totalprice, line_count, quantity,
               sin(2 * pi() * month(d) / 12) as month_sin,
               sin(2 * pi() * (dayofweek(d) + 1) / 7) as weekday_sin,
               cos(2 * pi() * month(d) / 12) as month_cos,
               cos(2 * pi() * (dayofweek(d) + 1) / 7) as weekday_cos,
               o_orderpriority, o_orderstatus
        from history
    """,
    "null_routing": f"""
        with {_HISTORY}
        select o_orderkey, line_count is null or quantity is null or gross is null as is_basic
        from history
    """,
    "nan_routing": f"""
        with {_HISTORY}
        select o_orderkey, case when quantity is null or o_orderstatus = 'P' then 'basic'
                                else 'full' end as variant
        from history
    """,
    "null_routing_sets": f"""
        with {_HISTORY}
        select o_orderkey, quantity,
               case when line_count is null or quantity is null or gross is null
                    then 'basic' else 'full' end as variant
        from history
    """,
    "cyclical": """
        with o as (select o_orderkey, month(o_orderdate) as m, day(o_orderdate) as d from orders),
        n as (select count(distinct m) as m, count(distinct d) as d from o)
        select o_orderkey,
               sin(2 * pi() * o.m / n.m) as month_sin, cos(2 * pi() * o.m / n.m) as month_cos,
               sin(2 * pi() * o.d / n.d) as day_sin, cos(2 * pi() * o.d / n.d) as day_cos
        from o cross join n
    """,
    "cyclical_null_period": """
        with o as (select o_orderkey, nullif(month(o_orderdate), 5) as m from orders),
        n as (select count(*) as n from (select distinct m from o))
        select o_orderkey, cast(m as integer) as month,
               sin(2 * pi() * m / n) as month_sin, cos(2 * pi() * m / n) as month_cos
        from o cross join n
    """,
    "distinct_values": """
        select (select count(*) from (select distinct o_orderpriority from orders))
                   as o_orderpriority,
               (select count(*) from (select distinct nullif(o_orderstatus, 'F') from orders))
                   as status,
               (select count(*) from (select distinct o_custkey from orders)) as o_custkey
    """,
    "group_totals": """
        with o as (select *, nullif(o_orderpriority, '5-LOW') as segment from orders)
        select o_orderkey, segment,
               cast(sum(cast(o_totalprice as decimal(18,2))) over (partition by segment) as double)
                   as sum_price_by_segment,
               count(*) over (partition by segment) as sum_one_by_segment
        from o where segment is not null
    """,
    "group_totals_trailing": """
        select o_orderkey, cast(sum(cast(o_totalprice as decimal(18,2))) over (
                   partition by o_custkey
                   order by date_diff('day', date '1970-01-01', cast(o_orderdate as date))
                   range between 29 preceding and current row) as double)
                   as sum_price_by_o_custkey_30d
        from orders where o_custkey is not null
    """,
    "minority_relabel": """
        with t as (
            select o_orderkey, cast(o_custkey as varchar) as customer,
                   sum(cast(o_totalprice as decimal(18,2))) over (partition by o_custkey) as s
            from orders where o_custkey is not null
        )
        select o_orderkey,
               case when s > 2500000 then customer else 'minor_segment' end as customer
        from t
    """,
    "dummies": """
        select o_orderkey,
               cast(o_orderpriority = '2-HIGH' as integer) as "o_orderpriority_2-HIGH",
               cast(o_orderpriority = '3-MEDIUM' as integer) as "o_orderpriority_3-MEDIUM",
               cast(o_orderpriority = '4-NOT SPECIFIED' as integer)
                   as "o_orderpriority_4-NOT SPECIFIED",
               cast(o_orderpriority = '5-LOW' as integer) as "o_orderpriority_5-LOW",
               cast(o_orderstatus = 'O' as integer) as "o_orderstatus_O",
               cast(o_orderstatus = 'P' as integer) as "o_orderstatus_P"
        from orders
    """,
    "dummy_vectors": """
        with customers as (
            select nullif(o_custkey, 7) as c, dense_rank() over (order by nullif(o_custkey, 7)) - 2 as slot,
                   o_orderkey
            from orders
        ),
        size as (select count(distinct c) - 1 as n from customers)
        select o_orderkey,
               case when c is null or c = (select min(c) from customers) then '(' || n || ',[],[])'
                    else '(' || n || ',[' || slot || '],[1.0])' end as customer_vec
        from customers cross join size
    """,
    "string_index": f"""
        with {_RANKS.format(name="priorities", column="o_orderpriority", more="")},
        {_RANKS.format(name="statuses", column="o_orderstatus", more="")}
        select o_orderkey,
               cast(coalesce(p.i, (select count(*) from priorities)) as double)
                   as o_orderpriority_tmp,
               cast(coalesce(s.i, (select count(*) from statuses)) as double) as o_orderstatus_tmp
        from orders left join priorities p on o_orderpriority = p.label
        left join statuses s on o_orderstatus = s.label
    """,
    "string_index_table": f"""
        with {_RANKS.format(name="customers", column="cast(o_custkey as varchar)", more="")},
        {_RANKS.format(name="priorities", column="o_orderpriority", more="")}
        select o_orderkey,
               cast(coalesce(c.i, (select count(*) from customers)) as double) as o_custkey_tmp,
               cast(coalesce(p.i, (select count(*) from priorities)) as double)
                   as o_orderpriority_tmp
        from orders left join customers c on cast(o_custkey as varchar) = c.label
        left join priorities p on o_orderpriority = p.label
    """,
    "one_hot": f"""
        with {_RANKS.format(name="ranks", column="o_orderpriority",
                            more=" and o_orderpriority <> '5-LOW'")}
        select o_orderkey, {_slots("i", "slot_", 5)}
        from orders left join ranks on o_orderpriority = label
    """,
    "assemble": f"""
        with {_RANKS.format(name="ranks", column="o_orderpriority", more="")}
        select o_orderkey, o_totalprice as feature_0,
               cast(month(o_orderdate) as double) as feature_1, {_slots("i", "feature_", 6, 2)}
        from orders left join ranks on o_orderpriority = label
    """,
    "union_folds": f"""
        with {_FOLDS}
        select o_orderkey, d as o_orderdate, o_totalprice, fold,
               date '2001-01-01' as dt_execution
        from folded
    """,
    "dedup_keys": "select distinct l_orderkey, l_linenumber from lineitem",
    "duplicate_check": """
        select (select count(*) from (select distinct l_orderkey, l_linenumber from lineitem))
               - (select count(*) from lineitem) as duplicates
    """,
    "fold_counts": f"with {_FOLDS} select fold, count(*) as row_count from folded group by fold",
    "month_report": """
        select strftime(o_orderdate, '%Y-%m') as month, count(o_orderpriority) as row_count,
               cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
        from orders group by 1 order by 1
    """,
    "date_range": f"""
        with {_FOLDS},
        rows as (
            select 'train' as role, cast(o_orderdate as date) as d
            from orders where o_orderdate < timestamp '2001-01-01'
            union all select 'test', d from folded
        )
        select role, min(d) as date_min, max(d) as date_max from rows group by role
    """,
    "run_metrics_train": """
        select 'o_totalprice' as col_target, 10 as num_trees, 5 as max_depth,
               'onethird' as max_features, cast(1 as double) as subsampling_rate,
               1 as min_samples_leaf, cast(1 as double) as training_sample,
               cast(min(o_orderdate) as date) as train_date_min,
               cast(max(o_orderdate) as date) as train_date_max
        from orders where o_orderdate < timestamp '2001-01-01'
    """,
    "run_metrics_predict": f"""
        with {_FOLDS},
        tested as (
            select f.*, exists (select 1 from lineitem where l_orderkey = o_orderkey) as has_lines
            from folded f
        )
        select (select count(*) from (select distinct o_custkey, o_orderpriority from tested))
                   - count(*) as check_duplicates,
               count(*) as results_full_count,
               count(*) filter (where has_lines) as test_set_count,
               count(*) filter (where not has_lines) as test_basic_set_count,
               min(d) as pred_date_min, max(d) as pred_date_max
        from tested
    """,
    "predict_checks": f"""
        with {_FOLDS},
        tested as (
            select f.*, exists (select 1 from lineitem where l_orderkey = o_orderkey) as has_lines
            from folded f
        )
        select (select count(*) from (select distinct o_orderkey, o_custkey from tested))
                   - count(*) as check_duplicates,
               count(*) as results_full_count,
               count(*) filter (where has_lines) as test_set_count,
               count(*) filter (where not has_lines) as test_basic_set_count,
               min(d) as pred_date_min, max(d) as pred_date_max,
               count(*) as csv_count
        from tested
    """,
    "results_written": f"""
        with {_HISTORY}
        select o_orderkey, d as o_orderdate, gross as o_totalprice_pred,
               cast(date_trunc('month', d) as date) as dt_execution
        from history
        where date_trunc('month', d) in
              (date '2000-11-01', date '2000-12-01', date '2001-01-01')
    """,
    "results_csv": """
        select o_orderkey, cast(o_orderdate as date) as o_orderdate, o_totalprice,
               date '2001-01-01' as dt_execution
        from orders
    """,
    "results_rerun": f"""
        with {_HISTORY}
        select o_orderkey, d as o_orderdate, gross as o_totalprice_pred,
               cast(date_trunc('month', d) as date) as dt_execution
        from history
        where date_trunc('month', d) <> date '2001-01-01' or gross is null
    """,
    "backtest": f"""
        with {_HISTORY},
        scored as (
            select cast(date_trunc('month', d) as date) as dt_execution,
                   abs((o_totalprice - gross) / nullif(o_totalprice, 0) * 100) as ape,
                   abs(o_totalprice - gross) as ae
            from history
            where d > (select max(cast(o_orderdate as date)) from orders) - 90
        ),
        flagged as (select *, coalesce(ape > 100, false) as is_outlier from scored)
        select dt_execution,
               round(avg(ape) filter (where not is_outlier), 6) as mape,
               round(avg(ae) filter (where not is_outlier), 4) as mae,
               round(sqrt(avg(ae * ae) filter (where not is_outlier)), 4) as rmse,
               count(*) filter (where not is_outlier) as row_count,
               count(*) filter (where is_outlier) as outlier_count
        from flagged group by 1
    """,
    "backtest_history": f"""
        with {_HISTORY},
        scored as (
            select cast(date_trunc('month', d) as date) as dt_execution,
                   abs((o_totalprice - gross) / nullif(o_totalprice, 0) * 100) as ape,
                   abs(o_totalprice - gross) as ae
            from history
            where d > (select max(cast(o_orderdate as date)) from orders) - 900
        ),
        flagged as (select *, coalesce(ape > 100, false) as is_outlier from scored)
        select dt_execution,
               round(avg(ape) filter (where not is_outlier), 6) as mape,
               round(avg(ae) filter (where not is_outlier), 4) as mae,
               round(sqrt(avg(ae * ae) filter (where not is_outlier)), 4) as rmse,
               count(*) filter (where not is_outlier) as row_count,
               count(*) filter (where is_outlier) as outlier_count
        from flagged group by 1
    """,
    "history_levels": f"""
        with {_HISTORY},
        rows as (
            select cast(date_trunc('month', d) as date) as dt_execution, o_orderpriority,
                   cast(o_totalprice as decimal(18,2)) as t, cast(gross as decimal(18,2)) as p
            from history where d between date '2000-01-15' and date '2001-02-10'
        ),
        sums as (
            select dt_execution, o_orderpriority,
                   grouping(dt_execution, o_orderpriority) as level,
                   cast(sum(t) as double) as sum_target, cast(sum(p) as double) as sum_prediction,
                   count(*) as row_count
            from rows
            group by grouping sets ((dt_execution, o_orderpriority), (dt_execution), (o_orderpriority))
        )
        select *, abs(sum_target - sum_prediction) as abs_error,
               abs((sum_target - sum_prediction) / nullif(sum_target, 0) * 100) as abs_perc_error
        from sums
    """,
    "rf_predict": f"""
        with {_FOLDS}, {_STUMP},
        tested as (
            select g.*, f.fold, case when many is null then 'basic' else 'full' end as variant
            from flagged g join folded f using (o_orderkey)
        )
        select o_orderkey, tested.d as o_orderdate, fold, variant, date '2001-01-01' as dt_execution,
               round(case when {_FLAG} then mean1 else mean0 end, 4) as o_totalprice_pred
        from tested join chosen using (fold, variant)
    """,
    "feature_importance": f"""
        with {_STUMP},
        slots as (
            select fold, place as idx, feature as name, feature as variable
            from folds join (values ('many', 0), ('bulky', 1), ('dear', 2)) v(feature, place)
                 on place < own
            union all select fold, own + i, name, 'o_orderpriority_catVec_' || name
            from folds cross join labels where variant = 'full'
            union all select fold, own + (select count(*) from labels where variant = 'full'), null,
                      'o_orderpriority_catVec___unknown'
            from folds
        )
        select s.fold, s.idx, s.variable,
               case when feature is not null then 1.0::double else 0.0::double end as importance,
               row_number() over (partition by s.fold order by feature is not null desc, s.idx) as rank,
               case s.fold when 0 then 'first' when 5 then 'last' end as model,
               'o_totalprice' as target_variable, date '2001-01-01' as dt_execution
        from slots s left join chosen c on c.variant = 'full' and c.fold = s.fold and c.feature = s.name
    """,
    "training_error": f"""
        with {_STUMP},
        judged as (
            select c.fold, c.variant, t, case when {_FLAG} then mean1 else mean0 end as p
            from flagged g join chosen c
                 on c.variant = case when many is null then 'basic' else 'full' end
            where past and c.fold in (0, 5)
        ),
        means as (
            select fold, variant, round(avg(abs((t - p) / nullif(t, 0) * 100)), 6) as mape,
                   round(avg(abs(t - p)), 4) as mae, count(*) as row_count
            from judged group by 1, 2
        )
        select fold, variant, mape, mae, coalesce(row_count, 0) as row_count
        from (values (0, 'full'), (0, 'basic'), (5, 'full'), (5, 'basic')) v(fold, variant)
             left join means using (fold, variant)
    """,
    "rf_predict_counts": f"""
        with {_FOLDS}, {_HISTORY}
        select f.fold, case when line_count is null then 'basic' else 'full' end as variant,
               date '2001-01-01' as dt_execution, count(*) as row_count,
               cast(sum(f.o_orderkey) as bigint) as key_sum,
               min(f.d) as date_min, max(f.d) as date_max
        from folded f join history h on f.o_orderkey = h.o_orderkey
        group by 1, 2
    """,
    "training_error_counts": f"""
        with {_HISTORY}
        select fold, case when line_count is null then 'basic' else 'full' end as variant,
               count(*) as row_count, true as has_error
        from history cross join (values (0), (5)) t(fold)
        where o_orderdate < timestamp '2001-01-01'
        group by 1, 2
    """,
    "feature_importance_totals": """
        with labels as (
            select count(distinct o_orderpriority) + 1 + count(distinct o_orderstatus) + 1 as n
            from orders where o_orderdate < timestamp '2001-01-01'
        )
        select fold, model, 'o_totalprice' as target_variable, date '2001-01-01' as dt_execution,
               n + own + 4 as variable_count, cast(1 as double) as importance
        from labels cross join (values (0, 3, 'first'), (1, 3, null), (2, 2, null), (3, 2, null),
                                       (4, 1, null), (5, 1, 'last')) t(fold, own, model)
    """,
}
