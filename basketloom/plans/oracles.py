"""The registered queries stated in plain SQL (DuckDB dialect), independently of the operators."""

from __future__ import annotations

from .registered import RULE_THRESHOLDS, THRESHOLDS

# Input tables and shared intermediates, in dependency order. Unused ones are not evaluated.
COMMON = {
    "ord_base": """
        select o_orderkey as order_id, o_custkey as user_id, o_orderdate,
               row_number() over w as num, lag(o_orderdate) over w as prev,
               count(*) over (partition by o_custkey) as user_orders
        from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey)""",
    "ord": """
        select order_id, user_id,
               case when num < user_orders then 'prior' when user_id % 3 = 0 then 'test'
                    else 'train' end as eval_set,
               cast(num as integer) as order_number,
               cast(order_id % 7 as integer) as order_dow,
               cast(order_id % 24 as integer) as order_hour_of_day,
               cast(case when prev is null then null
                         when date_diff('day', prev, o_orderdate) >= 300 then 30
                         else date_diff('day', prev, o_orderdate) // 10 end as double)
                   as days_since_prior_order
        from ord_base""",
    "merged": """
        select l_orderkey as order_id, l_partkey as product_id, min(l_linenumber) as ln
        from lineitem group by 1, 2""",
    "placed": """
        select f.order_id, f.product_id, f.ln, o.user_id, o.order_number, o.eval_set,
               row_number() over (partition by f.order_id order by f.ln, f.product_id) as cart,
               min(o.order_number) over (partition by o.user_id, f.product_id) as first_number
        from merged f join ord o on o.order_id = f.order_id where o.eval_set <> 'test'""",
    "line": """
        select order_id, product_id, cast(cart as integer) as add_to_cart_order,
               cast(order_number > first_number as integer) as reordered, eval_set as source
        from placed""",
    "prior_line": "select * exclude (source) from line where source = 'prior'",
    "train_line": "select * exclude (source) from line where source = 'train'",
    "typed_part": """
        select *, cast(split_part(p_brand, '#', 2) as integer) as aisle_id,
               cast(case when p_type is not null then dense_rank() over (order by p_type) end
                    as integer) as department_id from part""",
    "prod": """
        select p_partkey as product_id, p_name as product_name, aisle_id, department_id
        from typed_part""",
    "ais": """
        select aisle_id, min(case when aisle_id = 7 then ' Missing ' else lower(p_brand) end)
               as aisle from typed_part group by 1""",
    "dep": "select distinct department_id, lower(p_type) as department from typed_part",
    "bad": """
        select p.product_id from prod p join ais a using (aisle_id) join dep d using (department_id)
        where lower(trim(p.product_name, E' \\t\\n\\r')) = 'missing'
           or lower(trim(a.aisle, E' \\t\\n\\r')) = 'missing'
           or lower(trim(d.department, E' \\t\\n\\r')) = 'missing'""",
    "clean_line": "select * from line where product_id not in (select product_id from bad)",
    "clean_prod": "select * from prod where product_id not in (select product_id from bad)",
    "clean_ais": "select * from ais where lower(trim(aisle, E' \\t\\n\\r')) <> 'missing'",
    "clean_dep": "select * from dep where lower(trim(department, E' \\t\\n\\r')) <> 'missing'",
    "pur": """
        select l.order_id, l.product_id, l.add_to_cart_order, l.reordered, l.source, o.user_id,
               o.order_number, o.eval_set, p.aisle_id, p.department_id, a.aisle, d.department
        from clean_line l join ord o on o.order_id = l.order_id
        left join clean_prod p on p.product_id = l.product_id
        left join clean_ais a on a.aisle_id = p.aisle_id
        left join clean_dep d on d.department_id = p.department_id""",
    "target": """
        select o.user_id, max(o.order_id) as target_order_id,
               m.n as target_order_number, arg_max(o.eval_set, o.order_id) as eval_set
        from ord o join (select user_id, max(order_number) as n from pur group by 1) m
             on m.user_id = o.user_id and m.n = o.order_number
        group by o.user_id, m.n""",
    "hist": "select * from pur where order_id not in (select target_order_id from target)",
    "targ": "select * from pur where order_id in (select target_order_id from target)",
    "last_ord": """
        select * from ord
        qualify row_number() over (partition by user_id
                                   order by order_number desc, order_id desc) = 1""",
    "timeline": """
        select *, sum(coalesce(days_since_prior_order, 0)) over (
                      partition by user_id order by order_number
                      rows between unbounded preceding and current row) as user_cum_days
        from ord""",
    "last_day": "select user_id, max(user_cum_days) as u_last_cum_days from timeline group by 1",
    "detail": """
        select l.*, t.user_id, t.order_number, coalesce(t.days_since_prior_order, 0) as days,
               t.user_cum_days
        from prior_line l join timeline t on t.order_id = l.order_id""",
    "uf": """
        select d.user_id, count(*) as u_total_items,
               count(distinct d.product_id) as u_unique_products,
               max(d.order_number) as u_total_orders, avg(d.reordered) as u_reorder_ratio,
               avg(d.days) as u_avg_days, any_value(coalesce(x.u_last_cum_days, 0)) as u_last_cum_days
        from detail d left join last_day x on x.user_id = d.user_id group by d.user_id""",
    "pf": """
        select product_id, count(*) as p_total_purchases,
               count(distinct user_id) as p_unique_users, avg(reordered) as p_reorder_ratio,
               avg(add_to_cart_order) as p_avg_cart
        from detail group by product_id""",
    "upf": """
        select d.user_id, d.product_id, count(*) as up_buy_cnt,
               cast(sum(d.reordered) as bigint) as up_reorder_cnt,
               avg(d.add_to_cart_order) as up_cart_mean, min(d.order_number) as up_first_order,
               max(d.order_number) as up_last_order,
               sum(d.reordered) / count(*) as up_reorder_ratio,
               any_value(u.u_total_orders) - max(d.order_number) as up_orders_since_last,
               count(*) / any_value(u.u_total_orders) as up_freq,
               greatest(any_value(u.u_last_cum_days) - max(d.user_cum_days), 0)
                   as up_days_since_last
        from detail d join uf u on u.user_id = d.user_id group by d.user_id, d.product_id""",
    "lab": """
        select distinct o.user_id, l.product_id from train_line l
        join ord o on o.order_id = l.order_id where o.eval_set = 'train'""",
    "cand": """
        select u.*, f.* exclude (user_id), p.* exclude (product_id),
               coalesce(c.aisle_id, 0) as aisle_id, coalesce(c.department_id, 0) as department_id,
               case when b.user_id is null then 0 else 1 end as label
        from upf u join uf f on f.user_id = u.user_id join pf p on p.product_id = u.product_id
        left join prod c on c.product_id = u.product_id
        left join lab b on b.user_id = u.user_id and b.product_id = u.product_id""",
    "flagged": """
        select *, ('0x' || substr(md5(user_id::varchar), 1, 8))::bigint % 100 < 20 as held_out
        from cand""",
    "score": """
        select 'frequency' as model, user_id, product_id, label, up_freq as prob
        from flagged where held_out
        union all
        select 'recency', user_id, product_id, label, 1.0::double / (1 + up_orders_since_last)
        from flagged where held_out
        union all
        select 'repeat', user_id, product_id, label, up_reorder_ratio from flagged where held_out""",
    "val_ord": """
        select order_id, user_id from ord where eval_set = 'train'
          and ('0x' || substr(md5(user_id::varchar), 1, 8))::bigint % 100 < 20""",
    "truth": "select distinct order_id, product_id from train_line",
    "aligned": """
        select o.order_id, s.product_id, s.model, s.label, s.prob from score s
        join ord o on o.user_id = s.user_id and o.eval_set = 'train'""",
    "basket_item": "select distinct order_id, aisle as item from pur where aisle is not null",
    "kept_item": """
        select * from basket_item where order_id in
          (select order_id from basket_item group by 1 having count(*) >= 2)""",
    "single": "select item, count(*) as item_count from kept_item group by 1",
    "pair": """
        select a.item as item_a, b.item as item_b, count(*) as pair_count
        from kept_item a join kept_item b on a.order_id = b.order_id and a.item < b.item
        group by 1, 2""",
    "n_basket": "select count(distinct order_id)::double as n from kept_item",
    "rule": """
        select d.a as antecedent, d.b as consequent, pair_count, pair_count / n as support,
               pair_count / x.item_count as confidence,
               (pair_count / x.item_count) / (y.item_count / n) as lift
        from (select item_a as a, item_b as b, pair_count from pair
              union all select item_b, item_a, pair_count from pair) d
        join single x on x.item = d.a join single y on y.item = d.b cross join n_basket""",
    "good_rule": f"""
        select * from rule where support >= {RULE_THRESHOLDS["min_support"]}::double
          and confidence >= {RULE_THRESHOLDS["min_confidence"]}::double
          and lift >= {RULE_THRESHOLDS["min_lift"]}::double""",
    "bundle": """
        select *, least(antecedent, consequent) as item_a, greatest(antecedent, consequent) as item_b
        from good_rule
        qualify row_number() over (
            partition by least(antecedent, consequent), greatest(antecedent, consequent)
            order by round(lift, 9) desc, confidence desc, pair_count desc, antecedent) = 1""",
    "hist_order": """
        select user_id, order_id, count(*) as basket_size from hist group by 1, 2""",
    "segf": """
        select a.user_id, a.u_hist_orders, a.u_mean_days_between_orders, a.u_mean_basket_size,
               b.u_reorder_rate, b.u_unique_products
        from (select h.user_id, count(*) as u_hist_orders,
                     avg(coalesce(o.days_since_prior_order, 0)) as u_mean_days_between_orders,
                     avg(h.basket_size) as u_mean_basket_size
              from hist_order h join ord o on o.order_id = h.order_id group by 1) a
        full join (select user_id, avg(reordered) as u_reorder_rate,
                          count(distinct product_id) as u_unique_products
                   from hist group by 1) b on a.user_id = b.user_id""",
    "seg_aisle": """
        select cast(h.user_id % 4 as integer) as segment, h.aisle, count(*) as purchase_count
        from hist h where h.aisle is not null group by 1, 2""",
    "seg_share": """
        select *, cast(sum(purchase_count) over (partition by segment) as bigint) as segment_total,
               purchase_count / sum(purchase_count) over (partition by segment) as share
        from seg_aisle""",
    "base_pred": """
        select v.order_id, p.product_id from val_ord v join
          (select user_id, product_id from upf qualify row_number() over (
              partition by user_id order by up_buy_cnt desc, product_id) <= 11) p
          on p.user_id = v.user_id""",
    "ranked": """
        select *, row_number() over (partition by model, order_id order by prob desc, product_id)
               as rank from aligned""",
}


def order_means(predictions: str, by: str = "", dims: str = "") -> str:
    """Order-level means of a prediction relation (order_id, product_id[, by]).

    ``dims`` lists the values of ``by``, so that each meets every validation order.
    """
    key = f"{by}, " if by else ""
    frame = f"(select v.order_id, {key[:-2]} from val_ord v cross join {dims})" if by else "val_ord"
    same = f" and x.{by} = f.{by}" if by else ""
    group = f"group by {by}" if by else ""
    return f"""
      per_order as (
        select f.order_id, {f"f.{by}," if by else ""} coalesce(x.n_pred, 0) as n_pred,
               coalesce(t.n_true, 0) as n_true, coalesce(x.n_hit, 0) as n_hit
        from {frame} f
        left join (select p.order_id, {f"p.{by}," if by else ""} count(*) as n_pred,
                          count(t.product_id) as n_hit
                   from {predictions} p left join truth t
                        on t.order_id = p.order_id and t.product_id = p.product_id
                   group by all) x on x.order_id = f.order_id{same}
        left join (select order_id, count(*) as n_true from truth group by 1) t
             on t.order_id = f.order_id),
      scored as (
        select *, {PRECISION} as precision, {RECALL} as recall, {F1} as f1 from per_order),
      means as (
        select {key} round(avg(precision), 6) as precision, round(avg(recall), 6) as recall,
               round(avg(f1), 6) as f1,
               round(avg(n_pred), 6) as pred_size_mean,
               round(quantile_cont(n_pred, 0.5), 6) as pred_size_p50,
               round(quantile_cont(n_pred, 0.9), 6) as pred_size_p90,
               round(avg(n_true), 6) as true_size_mean,
               round(quantile_cont(n_true, 0.5), 6) as true_size_p50,
               round(quantile_cont(n_true, 0.9), 6) as true_size_p90
        from scored {group})"""


PRECISION = """case when n_pred = 0 and n_true = 0 then 1.0::double
      when n_pred = 0 then 0.0 else n_hit / n_pred end"""
RECALL = """case when n_pred = 0 and n_true = 0 then 1.0::double
      when n_true = 0 then 0.0 else n_hit / n_true end"""
F1 = """case when n_pred = 0 and n_true = 0 then 1.0::double
      when n_hit = 0 then 0.0
      else 2.0::double * (n_hit / n_pred) * (n_hit / n_true) / (n_hit / n_pred + n_hit / n_true)
      end"""

BASELINE_RANKS = """
      ranks as (
        select round(coalesce(avg(n_hit / n_true), 0), 6) as recall_at_k,
               round(coalesce(avg(case when n_hit > 0 then 1.0::double else 0.0 end), 0), 6)
                   as hit_at_k
        from per_order where n_true > 0)"""

MODEL_DIMS = "(values ('frequency'), ('recency'), ('repeat')) d(model)"


def with_common(body: str, extra: str = "") -> str:
    """A full statement: the shared relations, query-specific ones, and the final select."""
    parts = [f"{name} as ({text})" for name, text in COMMON.items()]
    if extra:
        parts.append(extra)
    return "with " + ",\n".join(parts) + "\n" + body


def histogram_sql(value: str, relation: str, bins: int) -> str:
    extra = f"""
      vals as (select cast({value} as double) as v from {relation} where {value} is not null),
      ends as (select case when min(v) = max(v) then min(v) - 0.5 else min(v) end as lo,
                      case when min(v) = max(v) then max(v) + 0.5 else max(v) end as hi from vals),
      hits as (select least(cast(floor((v - lo) / ((hi - lo) / {bins})) as integer), {bins} - 1)
                      as bin, count(*) as n from vals cross join ends group by 1)"""
    return with_common(
        f"""
      select cast(b.bin as integer) as bin, round(lo + b.bin * ((hi - lo) / {bins}), 6) as bin_lo,
             round(lo + (b.bin + 1) * ((hi - lo) / {bins}), 6) as bin_hi, coalesce(h.n, 0) as n
      from range({bins}) b(bin) cross join ends left join hits h on h.bin = b.bin""",
        extra,
    )


def describe_sql() -> str:
    tables = {
        "orders": (
            "ord",
            [
                "order_id",
                "user_id",
                "order_number",
                "order_dow",
                "order_hour_of_day",
                "days_since_prior_order",
            ],
        ),
        "prior": ("prior_line", ["order_id", "product_id", "add_to_cart_order", "reordered"]),
        "train": ("train_line", ["order_id", "product_id", "add_to_cart_order", "reordered"]),
    }
    return with_common(
        " union all ".join(
            f"""select '{c}' as "column", count({c}) as n, round(avg({c}), 4) as mean,
             round(stddev_samp({c}), 4) as std, round(min({c})::double, 4) as min,
             round(max({c})::double, 4) as max,
             round(quantile_cont({c}::double, 0.25), 4) as q25,
             round(quantile_cont({c}::double, 0.5), 4) as q50,
             round(quantile_cont({c}::double, 0.75), 4) as q75,
             '{name}' as "table" from {relation}"""
            for name, (relation, columns) in tables.items()
            for c in columns
        )
    )


def null_profile_sql() -> str:
    line = ["order_id", "product_id", "add_to_cart_order", "reordered"]
    order = [
        "order_id",
        "user_id",
        "eval_set",
        "order_number",
        "order_dow",
        "order_hour_of_day",
        "days_since_prior_order",
    ]
    tables = {"orders": ("ord", order), "prior": ("prior_line", line), "train": ("train_line", line)}
    return with_common(
        " union all ".join(
            f"""select '{name}' as "table", '{c}' as "column",
                count(*) filter (where {c} is null) as n_null from {relation}"""
            for name, (relation, columns) in tables.items()
            for c in columns
        )
    )


def audit_sql() -> str:
    shapes = {
        "orders": ("ord", 7, True),
        "prior": ("prior_line", 4, False),
        "train": ("train_line", 4, False),
        "products": ("prod", 4, False),
        "aisles": ("ais", 2, False),
        "departments": ("dep", 2, False),
        "purchases": ("pur", 12, True),
    }
    return with_common(
        " union all ".join(
            f"""select '{name}' as "table", count(*) as n_rows, {columns} as n_columns,
                {"count(distinct user_id)" if users else "null::bigint"} as n_users
                from {relation}"""
            for name, (relation, columns, users) in shapes.items()
        )
    )


def shares_sql() -> str:
    scopes = {"orders": "ord", "users": "last_ord", "target_orders": "target"}
    return with_common(
        " union all ".join(
            f"""select eval_set, count(*) as n,
                round_even(count(*) / sum(count(*)) over (), 4) as share, '{scope}' as scope
                from {relation} group by eval_set"""
            for scope, relation in scopes.items()
        )
    )


def group_share_sql() -> str:
    return with_common(
        " union all ".join(
            f"""select g.eval_set as user_group, count(*) as n_lines,
                count(distinct o.user_id) as n_users,
                round_even(count(*) / sum(count(*)) over (), 4) as share, '{source}' as source
                from clean_line l join ord o on o.order_id = l.order_id
                left join last_ord g on g.user_id = o.user_id
                where l.source = '{source}' group by g.eval_set"""
            for source in ("prior", "train")
        )
    )


def coverage_sql() -> str:
    return with_common(
        """select cast(t as integer) as threshold, count(*) filter (where n >= t) as n_users,
           round(count(*) filter (where n >= t) / count(*), 6) as share
           from (select user_id, max(order_number) as n from ord group by 1)
           cross join (values (2), (3), (5), (10), (20), (30)) x(t) group by t"""
    )


def tail_sql() -> str:
    measures = {
        "user_orders": "select max(order_number) as v from ord group by user_id",
        "target_basket_size": "select count(*) as v from targ group by order_id",
        "history_products_per_user": """select count(distinct product_id) as v from hist
                                        group by user_id""",
        "pair_purchases": "select count(*) as v from hist group by user_id, product_id",
        "days_since_prior_order": "select coalesce(days_since_prior_order, 0) as v from ord",
    }
    return with_common(
        " union all ".join(
            f"""select '{name}' as measure, count(v) as n, min(v)::double as min,
                max(v)::double as max,
                round(quantile_cont(v::double, 0.5), 6) as q50,
                round(quantile_cont(v::double, 0.9), 6) as q90,
                round(quantile_cont(v::double, 0.95), 6) as q95,
                round(quantile_cont(v::double, 0.99), 6) as q99,
                round(quantile_cont(v::double, 0.999), 6) as q999 from ({text})"""
            for name, text in measures.items()
        )
    )


def plot_quantiles(value: str) -> str:
    return ", ".join(
        f"round(quantile_cont({value}::double, {p}), 6) as {name}"
        for name, p in (("q50", 0.5), ("q90", 0.9), ("q99", 0.99))
    )


def category_sql(keys: str) -> str:
    first = keys.split(",")[0]
    return f"""select {keys}, count(*) as purchase_count, count(distinct user_id) as unique_users,
        avg(reordered) as reorder_ratio from hist where {first} is not null group by {keys}"""


def summary_sql(keys: str, tail: str = "") -> str:
    return with_common(
        f"""select {keys}, purchase_count, unique_users, round(reorder_ratio, 6) as reorder_ratio
            from ({category_sql(keys)}) {tail}"""
    )


def auc_extra() -> str:
    return """
      g as (select model, prob, sum(label) as pos, count(*) as n, count(*) - sum(label) as neg
            from score group by 1, 2),
      w as (select *, sum(neg) over up - neg as below, sum(pos) over down as hits_above,
                   sum(n) over down as rows_above,
                   sum(pos) over (partition by model) as all_pos,
                   sum(neg) over (partition by model) as all_neg
            from g
            window up as (partition by model order by prob),
                   down as (partition by model order by prob desc)),
      ranking as (
        select model,
               round(sum(pos * (below + neg / 2)) / max(all_pos::double * all_neg), 6) as auc,
               round(sum((pos / all_pos) * (hits_above / rows_above)), 6) as average_precision
        from w group by model)"""


LOG_LOSS = """
      select model, round(avg(-(label * ln(p) + (1 - label) * ln(1.0 - p))), 6) as log_loss
      from (select model, label, least(greatest(prob, 2.220446049250313e-16::double),
                   1.0::double - 2.220446049250313e-16::double) as p from score) group by model"""
BRIER = "select model, round(avg((prob - label) ** 2), 6) as brier from score group by model"
ECE = """
      select model, round(sum(n * off) / sum(n), 6) as ece from (
        select model, least(cast(floor(prob * 15) as integer), 14) as bin, count(*) as n,
               abs(avg(label) - avg(prob)) as off from score group by 1, 2) group by model"""


def scaled_sql() -> str:
    from ..operators.features import TABLE_FEATURES

    columns = ", ".join(
        f"""round((f.{c} - m.{c}_m) / case when m.{c}_s = 0 then 1 else m.{c}_s end, 6) + 0.0::double
            as {c}"""
        for c in TABLE_FEATURES
    )
    moments = ", ".join(
        f"avg({c}::double) as {c}_m, stddev_pop({c}::double) as {c}_s" for c in TABLE_FEATURES
    )
    return with_common(
        f"select f.user_id, f.product_id, {columns} from flagged f cross join m where f.held_out",
        f"m as (select {moments} from flagged where not held_out)",
    )


def segment_scaled_sql() -> str:
    columns = [
        "u_hist_orders",
        "u_mean_days_between_orders",
        "u_mean_basket_size",
        "u_reorder_rate",
        "u_unique_products",
    ]
    logged = {"u_hist_orders", "u_mean_basket_size", "u_unique_products"}
    values = ", ".join(
        f"{f'ln(1 + {c}::double)' if c in logged else f'{c}::double'} as {c}" for c in columns
    )
    moments = ", ".join(f"avg({c}) as {c}_m, stddev_pop({c}) as {c}_s" for c in columns)
    scaled = ", ".join(
        f"round((f.{c} - m.{c}_m) / case when m.{c}_s = 0 then 1 else m.{c}_s end, 6) + 0.0::double as {c}"
        for c in columns
    )
    return with_common(
        f"select f.user_id, {scaled} from f cross join m",
        f"f as (select user_id, {values} from segf), m as (select {moments} from f)",
    )


def threshold_sql() -> str:
    values = ", ".join(f"({t}::double)" for t in THRESHOLDS)
    extra = f"""
      th as (select * from (values {values}) x(threshold)),
      above as (select a.order_id, a.product_id, th.threshold from aligned a join th
                on a.prob >= th.threshold where a.model = 'frequency'),
      {order_means("above", "threshold", "th")}"""
    return with_common("select * from means", extra)


TOP_K_EXTRA = f"""
      top as (select order_id, product_id, model from ranked where rank <= 11),
      {order_means("top", "model", MODEL_DIMS)}"""


def method_sql() -> str:
    baseline = order_means("base_pred")
    for name in ("per_order", "scored", "means"):
        baseline = baseline.replace(name, f"base_{name}")
    return with_common(
        """select model || ' top-11' as method, precision, recall, f1, pred_size_mean from means
           union all
           select 'baseline top-11', precision, recall, f1, pred_size_mean from base_means""",
        TOP_K_EXTRA + "," + baseline,
    )


def recall_sql() -> str:
    return with_common(
        """select cast(k as integer) as k, round(avg(n_hit / n_true), 6) as recall_at_k,
                  round(avg(case when n_hit > 0 then 1.0::double else 0.0 end), 6) as hit_at_k
           from (select v.order_id, ks.k, count(distinct t.product_id) as n_true,
                        count(r.product_id) as n_hit
                 from val_ord v cross join (values (10), (20), (30)) ks(k)
                 join truth t on t.order_id = v.order_id
                 left join (select * from ranked where model = 'frequency') r
                   on r.order_id = v.order_id and r.product_id = t.product_id and r.rank <= ks.k
                 group by 1, 2) group by k"""
    )


FEATURE_COLUMNS = """u_total_items, u_unique_products, u_total_orders,
    round(u_reorder_ratio, 6) as u_reorder_ratio, round(u_avg_days, 6) as u_avg_days,
    round(u_last_cum_days, 6) as u_last_cum_days"""
PRODUCT_COLUMNS = """p_total_purchases, p_unique_users,
    round(p_reorder_ratio, 6) as p_reorder_ratio, round(p_avg_cart, 6) as p_avg_cart"""
PAIR_COLUMNS = """up_buy_cnt, up_reorder_cnt, round(up_cart_mean, 6) as up_cart_mean,
    up_first_order, up_last_order, round(up_reorder_ratio, 6) as up_reorder_ratio,
    up_orders_since_last, round(up_freq, 6) as up_freq,
    round(up_days_since_last, 6) as up_days_since_last"""
RULE_COLUMNS = """antecedent, consequent, pair_count, round(support, 6) as support,
    round(confidence, 6) as confidence, round(lift, 6) as lift"""


def oracles() -> dict[str, str]:
    """SQL per registered query name."""
    c = with_common
    popularity = """select product_id, count(*) as p_total_purchases, avg(reordered) as
                    p_reorder_ratio from hist group by 1"""
    return {
        # sources, cleaning
        "scan_orders": c("select * from ord"),
        "scan_order_lines": c("select * from line"),
        "scan_catalog": c(
            """select product_id, product_name, aisle_id, department_id, aisle, department
               from prod left join ais using (aisle_id) left join dep using (department_id)"""
        ),
        "table_preview": c("select * from ord order by order_id limit 10"),
        "vector_similarity": """
            with place as (select label, unnest(range(1, len(embedding) + 1)) as i,
                                  unnest(embedding)::double as x from embeddings),
            mean as (select label, i, avg(x) as x from place group by label, i),
            centre as (select label, list(x order by i) as c from mean group by label),
            sided as (select vec_id, label, embedding::double[] as v, c
                     from embeddings join centre using (label))
            select vec_id, label, round(sqrt(list_dot_product(v, v)), 6) as norm,
                   round(list_dot_product(v, c), 6) as dot,
                   round(list_dot_product(v, c)
                         / greatest(sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(c, c)), 1e-8),
                         6) as cosine
            from sided""",
        "numeric_describe": describe_sql(),
        "null_profile": null_profile_sql(),
        "table_audit": audit_sql(),
        "lenient_cast": c(
            """select order_id, product_id from prior_line
               where order_id % 10 <> 0 and product_id % 10 <> 3"""
        ),
        "fill_nulls": c(
            """select order_id, coalesce(days_since_prior_order, 0.0) as days_since_prior_order
               from ord"""
        ),
        "scrub_nonfinite": c(
            """select order_id, case when order_id % 5 in (0, 1, 2) then 0.0::double
                      else coalesce(days_since_prior_order, 0.0) end as gap from ord"""
        ),
        "missing_report": c(
            """select 'product_names' as what, count(*) as n from prod
                 where lower(trim(product_name)) = 'missing'
               union all select 'aisle_names', count(*) from ais where lower(trim(aisle)) = 'missing'
               union all select 'department_names', count(*) from dep
                 where lower(trim(department)) = 'missing'
               union all select 'products_removed', count(*) from bad
               union all select 'prior_lines_removed', count(*) from prior_line
                 where product_id in (select product_id from bad)
               union all select 'train_lines_removed', count(*) from train_line
                 where product_id in (select product_id from bad)"""
        ),
        "clean_products": c("select * from clean_prod"),
        "clean_aisles": c("select * from clean_ais"),
        "clean_departments": c("select * from clean_dep"),
        "clean_lines": c("select * from clean_line"),
        "null_pattern_check": c(
            """select count(*) filter (where days_since_prior_order is null) as n_null_gap,
                 count(*) filter (where days_since_prior_order is null and order_number = 1)
                   as n_null_gap_first,
                 count(*) filter (where order_number = 1) as n_first_orders from ord"""
        ),
        # purchases, target and history
        "enriched_lines": c("select * from pur"),
        "user_timeline": c("select order_id, user_id, order_number, user_cum_days from timeline"),
        "user_last_day": c("select * from last_day"),
        "last_order": c("select user_id, order_id, order_number, eval_set from last_ord"),
        "target_orders": c("select * from target"),
        "target_history_split": c(
            """select p.order_id, p.product_id, p.user_id, t.target_order_id,
                      p.order_id = t.target_order_id as is_target_order
               from pur p left join target t on t.user_id = p.user_id"""
        ),
        "target_lines": c("select order_id, product_id, user_id from targ"),
        "history_lines": c("select order_id, product_id, user_id from hist"),
        "eligible_users": c(
            """select user_id, count(distinct order_id) as n_history_orders from hist group by 1"""
        ),
        # features
        "user_features": c(f"select user_id, {FEATURE_COLUMNS} from uf"),
        "product_features": c(f"select product_id, {PRODUCT_COLUMNS} from pf"),
        "pair_features": c(f"select user_id, product_id, {PAIR_COLUMNS} from upf"),
        "labels": c("select user_id, product_id, 1 as label from lab"),
        "candidate_table": c(
            f"""select user_id, product_id, {FEATURE_COLUMNS}, {PRODUCT_COLUMNS}, {PAIR_COLUMNS},
                aisle_id, department_id, label from cand"""
        ),
        "labelled_candidates": c(
            """select user_id, product_id, up_buy_cnt, label from cand
               where user_id in (select user_id from ord where eval_set = 'train')"""
        ),
        "user_split": c("select distinct user_id, held_out as is_validation from flagged"),
        "positive_rate": c(
            """select count(*) as n_candidates, cast(sum(label) as bigint) as n_positive,
                 round(avg(label), 6) as positive_rate,
                 round((1 - avg(label)) / greatest(avg(label), 1e-6::double), 6) as positive_weight
               from cand"""
        ),
        # profiling
        "eval_set_shares": shares_sql(),
        "eval_sets_per_user": c(
            """select user_id, array_to_string(list_sort(list(distinct eval_set)), ',') as eval_sets
               from ord group by 1"""
        ),
        "line_share_by_group": group_share_sql(),
        "order_count_coverage": coverage_sql(),
        "user_order_counts": c(
            "select user_id, max(order_number) as u_all_orders from ord group by 1"
        ),
        "tail_summary": tail_sql(),
        "basket_sizes": c("select order_id, count(*) as basket_size from targ group by 1"),
        "basket_size_stats": c(
            """select round(avg(n), 6) as mean, round(quantile_cont(n::double, 0.5), 6) as median,
                 round(quantile_cont(n::double, 0.9), 6) as p90
               from (select count(*) as n from targ group by order_id)"""
        ),
        "hist_user_orders": histogram_sql(
            "x", "(select max(order_number) as x from ord group by user_id)", 80
        ),
        "hist_basket_size": histogram_sql(
            "x", "(select count(*) as x from targ group by order_id)", 80
        ),
        "hist_candidate_size": histogram_sql(
            "x", "(select count(distinct product_id) as x from hist group by user_id)", 80
        ),
        "hist_gap_days": histogram_sql(
            "x", "(select coalesce(days_since_prior_order, 0) as x from ord)", 31
        ),
        "hist_product_purchases": histogram_sql(
            "x", "(select ln(1 + count(*)::double) as x from hist group by product_id)", 80
        ),
        "hist_product_reorder": histogram_sql(
            "x", "(select avg(reordered) as x from hist group by product_id)", 60
        ),
        "hist_department_purchases": histogram_sql(
            "ln(1 + purchase_count::double)", f"({category_sql('department_id, department')})", 30
        ),
        "hist_department_reorder": histogram_sql(
            "reorder_ratio", f"({category_sql('department_id, department')})", 20
        ),
        "hist_aisle_purchases": histogram_sql(
            "ln(1 + purchase_count::double)", f"({category_sql('aisle_id, aisle')})", 40
        ),
        "hist_aisle_reorder": histogram_sql(
            "reorder_ratio", f"({category_sql('aisle_id, aisle')})", 30
        ),
        "count_of_counts": c(
            """select cast(r.k as integer) as k, coalesce(x.n, 0) as n_pairs
               from range(1, 22) r(k) left join
                 (select least(n, 21) as k, count(*) as n from
                    (select count(*) as n from hist group by user_id, product_id) group by 1) x
               on x.k = r.k"""
        ),
        "candidate_size": c(
            "select user_id, count(distinct product_id) as n_products from hist group by 1"
        ),
        "candidate_size_quantiles": c(
            f"""select {plot_quantiles('n')} from
                (select count(distinct product_id) as n from hist group by user_id)"""
        ),
        "recency_curve": c(
            """select cast(b.o as integer) as bin_ord, b.l as bin,
                      round(avg(r.label), 6) as purchase_prob, count(r.label) as n_pairs
               from (values (0, '0', -0.5, 0.5), (1, '1', 0.5, 1.5), (2, '2', 1.5, 2.5),
                     (3, '3', 2.5, 3.5), (4, '4', 3.5, 4.5), (5, '5', 4.5, 5.5),
                     (6, '6-10', 5.5, 10.5), (7, '11-20', 10.5, 20.5), (8, '>20', 20.5, 1e9))
                    b(o, l, lo, hi)
               left join
                 (select t.target_order_number - h.n as since,
                         case when exists (select 1 from targ g where g.user_id = h.user_id
                              and g.product_id = h.product_id) then 1 else 0 end as label
                  from (select user_id, product_id, max(order_number) as n from hist group by 1, 2) h
                  join target t on t.user_id = h.user_id) r
               on r.since > b.lo and r.since <= b.hi group by 1, 2"""
        ),
        "orders_by_hour": c(
            "select order_hour_of_day, count(*) as n_orders from ord group by 1"
        ),
        "busiest_hours": c(
            """select order_hour_of_day, count(*) as n_orders from ord group by 1
               order by 2 desc, 1 limit 5"""
        ),
        "gap_quantiles": c(
            f"select {plot_quantiles('coalesce(days_since_prior_order, 0)')} from ord"
        ),
        "product_popularity": c(
            f"""select product_id, p_total_purchases, round(p_reorder_ratio, 6) as p_reorder_ratio
                from ({popularity})"""
        ),
        "product_popularity_quantiles": c(
            f"""select 'p_total_purchases' as measure, {plot_quantiles('p_total_purchases')}
                from ({popularity}) union all
                select 'p_reorder_ratio', {plot_quantiles('p_reorder_ratio')} from ({popularity})"""
        ),
        "department_summary": summary_sql("department_id, department"),
        "aisle_summary": summary_sql("aisle_id, aisle"),
        "top_aisles_by_count": summary_sql(
            "aisle_id, aisle", "order by purchase_count desc, aisle_id limit 15"
        ),
        "top_aisles_by_reorder": c(
            f"""select aisle_id, aisle, purchase_count, unique_users,
                       round(reorder_ratio, 6) as reorder_ratio
                from (select * from ({category_sql('aisle_id, aisle')})
                      where purchase_count >= 1000 order by reorder_ratio desc, aisle_id limit 15)"""
        ),
        # baskets
        "aisle_baskets": c(
            """select order_id, string_agg(item, '|' order by item) as basket
               from kept_item group by 1"""
        ),
        "item_counts": c("select * from single"),
        "item_pair_counts": c("select * from pair"),
        "association_rules": c(f"select {RULE_COLUMNS} from rule"),
        "filtered_rules": c(f"select {RULE_COLUMNS} from good_rule"),
        "bundle_pairs": c(f"select {RULE_COLUMNS}, item_a, item_b from bundle"),
        "bundle_pair_count": c("select count(*) as n_pairs from bundle"),
        "top_bundles": c(
            f"""select {RULE_COLUMNS} from (select * from bundle order by round(lift, 9) desc,
                confidence desc, pair_count desc, antecedent, consequent limit 15)"""
        ),
        "bundle_edges": c(
            """select item_a, item_b, round(lift, 6) as weight, round(support, 6) as support,
                      pair_count from bundle"""
        ),
        "bundle_nodes": c(
            """select item, count(*) as degree from
               (select item_a as item from bundle union all select item_b from bundle) group by 1"""
        ),
        # segments
        "segment_features": c(
            """select user_id, u_hist_orders,
                 round(u_mean_days_between_orders, 6) as u_mean_days_between_orders,
                 round(u_mean_basket_size, 6) as u_mean_basket_size,
                 round(u_reorder_rate, 6) as u_reorder_rate, u_unique_products from segf"""
        ),
        "segment_features_scaled": segment_scaled_sql(),
        "segment_profile_by_group": c(
            """select cast(user_id % 4 as integer) as segment, count(*) as n_users,
                 round(avg(u_hist_orders), 6) as u_hist_orders,
                 round(avg(u_mean_days_between_orders), 6) as u_mean_days_between_orders,
                 round(avg(u_mean_basket_size), 6) as u_mean_basket_size,
                 round(avg(u_reorder_rate), 6) as u_reorder_rate,
                 round(avg(u_unique_products), 6) as u_unique_products from segf group by 1"""
        ),
        "segment_aisles_by_group": c(
            """select segment, aisle, purchase_count, segment_total, round(share, 6) as share
               from seg_share"""
        ),
        "cross_sell_by_group": c(
            """select segment, aisle, purchase_count, segment_total, round(share, 6) as share
               from (select * from seg_share qualify row_number() over (partition by segment
                     order by share desc, purchase_count desc, aisle) <= 5)"""
        ),
        # evaluation
        "topk_baseline_eval": c(
            "select *, 11 as k from means cross join ranks",
            order_means("base_pred") + "," + BASELINE_RANKS,
        ),
        "order_prf": c(
            """select order_id, n_pred, n_true, n_hit, round(precision, 6) as precision,
                      round(recall, 6) as recall, round(f1, 6) as f1 from scored""",
            order_means("base_pred"),
        ),
        "frequent_products": c(
            """select user_id, product_id, up_buy_cnt from upf qualify row_number() over (
               partition by user_id order by up_buy_cnt desc, product_id) <= 11"""
        ),
        "score_alignment": c(
            """select order_id, product_id, label, round(prob, 6) as prob from aligned
               where model = 'frequency'"""
        ),
        "auc": c("select model, auc from ranking", auc_extra()),
        "average_precision": c("select model, average_precision from ranking", auc_extra()),
        "logloss": c(LOG_LOSS),
        "brier": c(BRIER),
        "ece": c(ECE),
        "row_metrics": c(
            f"""select r.*, l.log_loss, b.brier, e.ece from ranking r join ({LOG_LOSS}) l using (model)
                join ({BRIER}) b using (model) join ({ECE}) e using (model)""",
            auc_extra(),
        ),
        "threshold_eval": threshold_sql(),
        "top_k_predictions": c(
            """select order_id, product_id, label, round(prob, 6) as prob,
                      cast(rank as integer) as rank
               from ranked where model = 'frequency' and rank <= 11"""
        ),
        "topk_eval": c("select *, 11 as k from means", TOP_K_EXTRA),
        "recall_hit_at_k": recall_sql(),
        "model_preference": c(
            """select model, cast(case model when 'recency' then 1 when 'frequency' then 2
                      else 3 end as integer) as preference
               from (select distinct model from score) order by 2, 1 limit 1"""
        ),
        "method_summary": method_sql(),
        "blend_scores": c(
            """select a.user_id, a.product_id, a.label,
                      round(0.2::double * a.prob + 0.8::double * b.prob, 6) as prob
               from score a join score b on a.user_id = b.user_id and a.product_id = b.product_id
               where a.model = 'frequency' and b.model = 'recency'"""
        ),
        # learning
        "scaled_features": scaled_sql(),
    }
