"""DuckDB SQL equivalents of the registered queries (independent oracle).

Tables are the driver's parquet views; ``T`` adapts ``events`` to ticks with
plain window functions (the textbook, single-task formulation the Spark plans
avoid). Computed doubles are rounded to 6 places, as on the Spark side.
"""

FEATS = ("price", "volume", "market_cap")

# Tick CTE (same adapter as tickweave.sources.events), with positions.
T = """
with t as (
  select event_type as currency, ts as dt, event_id, value as price,
         cast(json_extract_string(props, '$.k') as double) as volume,
         value * (user_id + 1) as market_cap,
         row_number() over (partition by event_type order by ts, event_id) - 1 as pos,
         count(*) over (partition by event_type) as n
  from events)
"""
# Hourly series: every 12th tick, renumbered (p, m = series length).
H = T + """,
h as (select currency, event_id, dt, pos // 12 as p, (n + 11) // 12 as m, price, volume, market_cap
      from t where pos % 12 = 0)
"""


def _feats(fmt: str, suffix: str) -> str:
    return ", ".join(f"round({fmt.format(c=c)}, 6) as {c}{suffix}" for c in FEATS)


PERSIST = T + """,
f as (select currency, pos, n, price,
             lead(price, 1) over w as f1, lead(price, 2) over w as f2, lead(price, 3) over w as f3,
             avg(price) over (partition by currency order by pos rows between 34 preceding and current row) as wm
      from t window w as (partition by currency order by pos)),
s as (select currency, pos - 34 as window_id, price as predicted, wm,
             unnest([1, 2, 3]) as horizon, unnest([f1, f2, f3]) as actual
      from f where pos >= 34 and pos + 3 <= n - 1)
"""

METRICS = """count(*) as n,
  round(avg((predicted - actual) * (predicted - actual)), 6) as mse,
  round(sqrt(avg((predicted - actual) * (predicted - actual))), 6) as rmse,
  round(avg(abs(predicted - actual)), 6) as mae,
  round(avg(predicted - actual), 6) as mean_error"""

# Rows held out of each stratum (of st) by largest remainders.
HELD = """
      a as (select *, n - cast(ceil(cast(n as double) * cast(0.1111 as double)) as bigint) as kept
            from (select currency, stratum, count(*) as size, sum(count(*)) over (partition by currency) as n from st group by 1, 2)),
      b as (select *, size * kept // n as whole, size * kept % n as over from a),
      c as (select currency, stratum, size - whole - cast(
                     row_number() over (partition by currency order by over desc, stratum) <= kept - sum(whole) over (partition by currency) as integer) as held
            from b)"""
STRATA = T + """,
st as (select currency, event_id, pos, n,
              cast(case when n // 12 = 0 then 11 else least(pos // (n // 12), 11) end as bigint) as stratum
       from t)
"""

# The last tick of every series and second.
POINTS = T + """,
s as (select *, row_number() over (partition by currency, date_trunc('second', dt) order by dt desc, event_id desc) as back from t)
select currency, date_trunc('second', dt) as dt, round(price, 6) as price, round(volume, 6) as volume,
       round(market_cap, 6) as market_cap from s where back = 1"""

SQL: dict[str, str] = {
    "w1_position": T + "select event_id, currency, pos, n from t",
    "w2_every_nth": H + "select event_id, currency, round(price, 6) as price, p as pos, m as n from h",
    "w2_every_nth_drop1": H
    + "select event_id, currency, p - 1 as pos, greatest(m - 1, 0) as n from h where p >= 1",
    "p3_one_currency": T + "select event_id, dt, round(price, 6) as price from t where currency = 'click'",
    "p4_currencies": T + "select event_id, currency from t where currency in ('click', 'view')",
    "p2_typed": "select event_id, try_cast(json_extract_string(props, '$.k') as bigint) as k from events",
    "p7_derived": T
    + "select event_id, round(price * volume, 6) as turnover, "
    "round(case when market_cap + 1 > 0 then ln(market_cap + 1) end, 6) as log_mcap from t",
    "p9_rescale": T
    + "select event_id, round(price * 1000.0, 6) as price_k, round(price * 1000.0 * cast(1/1000 as double), 6) as price_back from t",
    "p10_row_at": T + "select currency, event_id, round(price, 6) as price from t where pos = 100",
    "p11_stack": T
    + "select event_id, cast(unnest(range(3)) as bigint) as k, "
    "round(unnest([ln(price + 1), ln(volume + 1), ln(market_cap + 1)]), 6) as v from t",
    "s9_money": """
      select l_orderkey, l_linenumber, money_text,
             try_cast(regexp_replace(money_text, '[$,\\s]', '', 'g') as double) as amount
      from (select l_orderkey, l_linenumber, '$' || format('{:,.2f}', l_extendedprice) as money_text from lineitem)""",
    "f1_log1p": T + "select event_id, " + _feats("ln({c} + 1)", "_ln") + " from t",
    "f2_log10": T + "select event_id, round(case when price > 0 then log10(price) end, 6) as log10_price from t",
    "f3_expm1": T + "select event_id, round(exp(ln(price + 1)) - 1, 6) as price_back from t",
    "f5_epoch": """
      select event_id, epoch, strftime(make_timestamp(epoch * 1000000), '%Y-%m-%d %H:%M:%S') as ts_text
      from (select event_id, cast(floor(epoch(ts)) as bigint) as epoch from events)""",
    "f6_dates": """
      select event_id, cast(ts as date) as d_, cast(ts as date) + 1 as next_d,
             cast(cast(ts as date) - date '1970-01-01' as bigint) as epoch_day from events""",
    "f7_slug": """
      select event_type as currency,
             regexp_replace(lower(trim(upper(event_type[1]) || lower(event_type[2:]) || '  Coin')), '\\s+', '-', 'g') as slug,
             replace(event_type, 'i', '1') as replaced
      from (select distinct event_type from events)""",
    "f9_flatten": H
    + """,
      wn as (select currency, p as window_id from h where p + 38 <= m)
      select wn.currency, wn.window_id, cast((h.p - wn.window_id) * 3 + f.j as bigint) as k,
             round(case f.j when 0 then h.price when 1 then h.volume else h.market_cap end, 6) as v
      from wn join h on h.currency = wn.currency and h.p between wn.window_id and wn.window_id + 34,
           (select unnest(range(3)) as j) f""",
    "a1_count": T + "select currency, count(*) as n from t group by 1",
    "a2_sum_avg": T + "select currency, count(*) as n, round(sum(price), 6) as total, round(avg(price), 6) as average from t group by 1",
    "a3_stats": T
    + "select currency, "
    + ", ".join(f"round(avg({c}), 6) as {c}_mean, round(stddev_samp({c}), 6) as {c}_sd" for c in FEATS)
    + " from t group by 1",
    "a4_stats_pop": T
    + "select currency, "
    + ", ".join(f"round(avg({c}), 6) as {c}_mean, round(stddev_pop({c}), 6) as {c}_sd" for c in FEATS)
    + " from t group by 1",
    "a5_robust_stats": T
    + "select currency, "
    + ", ".join(
        f"round(quantile_cont({c}, 0.25), 6) as {c}_q25, round(quantile_cont({c}, 0.5), 6) as {c}_med, "
        f"round(quantile_cont({c}, 0.75), 6) as {c}_q75, "
        f"round(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 6) as {c}_iqr"
        for c in FEATS
    )
    + " from t group by 1",
    "a6_minmax": T
    + "select currency, "
    + ", ".join(f"round(min({c}), 6) as {c}_min, round(max({c}), 6) as {c}_max" for c in FEATS)
    + " from t group by 1",
    "a7_pair_corr": T + "select currency, round(corr(price, volume), 6) as corr from t group by 1",
    "a7_pair_corr_nulls": T
    + """, c as (select currency, case when event_id % 7 <> 0 then price end as p, case when event_id % 5 <> 0 then volume end as v from t)
      select currency, round(corr(p, v), 6) as corr from c group by 1""",
    "a8_corr_changes": """
      with d as (select event_type as currency, cast(ts as date) as d_, max_by(value, ts) as close from events group by 1, 2),
      g as (select currency, d_, close / nullif(lag(close) over (partition by currency order by d_), 0) - 1 as v from d),
      b as (select d_, v as base_v from g where currency = 'click'),
      c as (select g.currency as coin, round(corr(b.base_v, g.v), 6) as corr from g join b using (d_) group by 1)
      select coin, corr, row_number() over (order by corr desc, coin) as rank from c order by corr desc, coin limit 3""",
    "a8_corr_sweep": """
      with d as (select event_type as currency, cast(ts as date) as d_, avg(value) as v from events group by 1, 2),
      b as (select d_, v as base_v from d where currency = 'click')
      select d.currency as coin, count(*) as n, round(corr(b.base_v, d.v), 6) as corr
      from d join b using (d_) group by 1""",
    "t4_rank_corr": """
      with d as (select event_type as currency, cast(ts as date) as d_, avg(value) as v from events group by 1, 2),
      b as (select d_, v as base_v from d where currency = 'click'),
      c as (select d.currency as coin, round(corr(b.base_v, d.v), 6) as corr from d join b using (d_) group by 1)
      select coin, corr, row_number() over (order by corr desc, coin) as rank from c order by corr desc, coin limit 3""",
    "p6_trim_sentinel": T
    + """,
      s as (select currency, pos, case when pos = n - 5 * length(currency) then 100000.0 else price end as v from t),
      e as (select currency, coalesce(min(pos) filter (where v = 100000.0), 4611686018427387904) as end_pos
            from s group by 1),
      b as (select s.pos, s.v as base_v, e.end_pos as base_end from s join e using (currency) where currency = 'click')
      select s.currency as coin, count(*) as n, round(corr(b.base_v, s.v), 6) as corr
      from s join e using (currency) join b using (pos)
      where s.pos < least(e.end_pos, b.base_end) group by 1""",
    "a9_blocks": T
    + """select currency, pos // 32 as block_id, round(avg(price), 8) as y, count(*) as rows,
             round(min_by(volume, pos), 6) as first_vol, round(max_by(volume, pos), 6) as last_vol
      from t group by 1, 2 having count(*) = 32""",
    "a10_metrics": PERSIST + "select currency, " + METRICS + " from s group by 1",
    "a11_mean_error": PERSIST
    + "select currency, " + METRICS.replace("predicted", "wm") + " from s group by 1",
    "a12_r2": PERSIST
    + """,
      r as (select currency, horizon,
                   1 - sum((predicted - actual) * (predicted - actual)) / (var_pop(actual) * count(actual)) as r2
            from s group by 1, 2)
      select currency, round(avg(r2), 6) as r2, count(*) as horizons from r group by 1""",
    "a17_compare": PERSIST
    + """,
      u as (select 'persistence' as model, predicted, actual from s
            union all select 'window_mean' as model, wm as predicted, actual from s),
      m as (select model, """
    + METRICS
    + """, sqrt(avg((predicted - actual) * (predicted - actual))) as raw_rmse from u group by 1)
      select model, n, mse, rmse, mae, mean_error, rank() over (order by raw_rmse, model) as rank from m""",
    "a13_acf": T
    + """,
      z as (select currency, pos, price - avg(price) over (partition by currency) as z from t),
      l as (select currency, z, """
    + ", ".join(f"lead(z, {h}) over w as z{h}" for h in range(1, 11))
    + """ from z window w as (partition by currency order by pos)),
      a as (select currency, count(z) as n, sum(z * z) as c0, ["""
    + ", ".join(f"coalesce(sum(z * z{h}), 0)" for h in range(1, 11))
    + """] as s from l group by 1)
      select currency, cast(unnest(range(1, 11)) as bigint) as lag, round(unnest(s) / c0, 6) as acf,
             round(1.959963984540054 / sqrt(n), 6) as band95, round(2.5758293035489004 / sqrt(n), 6) as band99
      from a""",
    "a13_acf_all": T
    + """,
      z as (select currency, pos, price - avg(price) over (partition by currency) as z from t),
      s as (select currency, count(z) as n, sum(z * z) as c0 from z group by 1),
      p as (select a.currency, b.pos - a.pos as lag, sum(a.z * b.z) as p from z a join z b on a.currency = b.currency and a.pos < b.pos group by all)
      select currency, lag, round(p / nullif(c0, 0), 6) as acf, round(1.959963984540054 / sqrt(n), 6) as band95,
             round(2.5758293035489004 / sqrt(n), 6) as band99
      from p join s using (currency)""",
    "a14_adf": T
    + """,
      l as (select currency, price - lag(price) over w as dy, lag(price) over w as y1
            from t window w as (partition by currency order by pos))
      select currency, round(regr_slope(dy, y1), 6) as gamma,
             round(regr_slope(dy, y1) / sqrt((1 - regr_r2(dy, y1)) * regr_syy(dy, y1)
                   / ((cast(regr_count(dy, y1) as bigint) - 2) * regr_sxx(dy, y1))), 6) as t_stat,
             cast(regr_count(dy, y1) as bigint) as nobs
      from l group by 1""",
    "a14_adf_lag1": T
    + """,
      l as (select currency, price, lag(price) over w as y1, price - lag(price) over w as dy,
                   lag(price) over w - lag(price, 2) over w as dy1, lag(price, 2) over w as y2, lag(price, 3) over w as y3
            from t window w as (partition by currency order by pos)),
      c as (select currency, sum(price * price) as p0, sum(price * y1) as p1, sum(price * y2) as p2, sum(price * y3) as p3 from l group by 1),
      m as (select currency, count(*) as n, regr_sxx(dy, y1) as s11, regr_sxx(dy, dy1) as s22, regr_sxy(dy1, y1) as s12,
                   regr_sxy(dy, y1) as sy1, regr_sxy(dy, dy1) as sy2, regr_syy(dy, y1) as syy
            from l where dy1 is not null group by 1),
      b as (select *, s11 * s22 - s12 * s12 as det, (sy1 * s22 - sy2 * s12) / (s11 * s22 - s12 * s12) as g,
                   (sy2 * s11 - sy1 * s12) / (s11 * s22 - s12 * s12) as h from m)
      select currency, round(g, 6) as gamma, round(g / sqrt((syy - g * sy1 - h * sy2) / (n - 3) * s22 / det), 6) as t_stat, n as nobs,
             round(p0, 6) as product0, round(p1, 6) as product1, round(p2, 6) as product2, round(p3, 6) as product3
      from b join c using (currency)""",
    "w3_windows_long": H
    + """,
      wn as (select currency, p as window_id from h where p + 38 <= m)
      select wn.currency, wn.window_id, h.p - wn.window_id as h, round(h.price, 6) as v
      from wn join h on h.currency = wn.currency and h.p between wn.window_id and wn.window_id + 37""",
    "w3_windows_explode": H
    + """,
      wn as (select currency, p as window_id from h where p + 38 <= m)
      select wn.currency, wn.window_id, h.p - wn.window_id as h, round(h.price, 6) as v
      from wn join h on h.currency = wn.currency and h.p between wn.window_id and wn.window_id + 37""",
    "w4_windows_60_1": H
    + """,
      wn as (select currency, p as window_id from h where p + 61 <= m)
      select wn.currency, count(*) as n_windows, round(avg(h.price), 6) as mean_y
      from wn join h on h.currency = wn.currency and h.p = wn.window_id + 60 group by 1""",
    "w6_pct_change": T
    + """select event_id, round(price / nullif(lag(price) over w, 0) - 1, 6) as pct_change
      from t window w as (partition by currency order by pos)""",
    "w7_log_return": T
    + """select event_id, round(case when price / nullif(lag(price) over w, 0) > 0
                                     then ln(price / nullif(lag(price) over w, 0)) end, 6) as log_return
      from t window w as (partition by currency order by pos)""",
    "w8_diff2": T
    + """select event_id, round((price - lag(price, 1) over w) - (lag(price, 1) over w - lag(price, 2) over w), 6)
             + cast(0 as double) as diff2
      from t window w as (partition by currency order by pos)""",
    "w9_split_counts": T
    + """select currency, case when pos < floor(n * cast(0.9 as double)) then 'train'
                               when pos < floor(n * cast(0.95 as double)) then 'val' else 'test' end as split,
             count(*) as rows from t group by 1, 2""",
    "w10_last_k": T + "select event_id, case when pos >= n - 235 then 'test' else 'train' end as split from t",
    "w11_slice": T
    + """select event_id, currency, pos - greatest(n - 1000, 0) as pos,
             greatest(n - 100, greatest(n - 1000, 0)) - greatest(n - 1000, 0) as n
      from t where pos >= greatest(n - 1000, 0) and pos < greatest(n - 100, 0)""",
    "t2_first_n": T + "select event_id, currency, pos from t where pos < 100",
    "t3_last_n": T + "select event_id, currency, pos - greatest(n - 300, 0) as pos from t where pos >= n - 300",
    "w12_strata": STRATA + "select currency, stratum, count(*) as rows from st group by 1, 2",
    "w13_holdout": STRATA
    + """,
      r as (select currency, event_id, stratum,
                   row_number() over (partition by currency, stratum order by md5(cast(event_id as varchar)), event_id) as rk,
                   count(*) over (partition by currency, stratum) as sz from st)
      select currency, event_id, stratum from r where rk <= round(sz * cast(0.1111 as double))""",
    "w13_holdout_exact": STRATA
    + "," + HELD
    + """,
      r as (select currency, event_id, stratum,
                   row_number() over (partition by currency, stratum order by md5(cast(event_id as varchar)), event_id) as rk from st)
      select currency, event_id, stratum from r join c using (currency, stratum) where rk <= held""",
    "w13_split_chain": H
    + """,
      wn as (select currency, p as window_id, m - 37 as n, cast(floor(cast(m - 37 as double) * cast(0.9 as double)) as bigint) as n2 from h where p + 38 <= m),
      st as (select currency, window_id, least(case when n2 // 12 = 0 then 11 else window_id // (n2 // 12) end, 11) as stratum from wn where window_id < n2),"""
    + HELD
    + """,
      r as (select currency, window_id, stratum,
                   row_number() over (partition by currency, stratum order by md5(cast(window_id as varchar)), window_id) as rk from st)
      select currency, window_id, case when rk <= held then 'val' else 'train' end as split from r join c using (currency, stratum)
      union all select currency, window_id, 'test' from wn where window_id >= n2""",
    "w14_align": H
    + """,
      wn as (select currency, p as window_id from h where p + 38 <= m)
      select wn.currency, wn.window_id, h.p - wn.window_id - 34 as horizon, h.p as target_pos, round(h.price, 6) as value
      from wn join h on h.currency = wn.currency and h.p between wn.window_id + 35 and wn.window_id + 37""",
    "t1_sorted_limit": "select event_id, ts as dt, event_type as currency from events order by ts, event_id limit 100",
    "t5_repartition": T
    + "select count(*) as n, round(corr(price, volume), 6) as corr, round(sum(price), 6) as total, "
    "round(avg(price), 6) as average from t",
    "j1_zip": T
    + """select a.currency, a.pos, round(ln(a.price + 1), 6) as x, round(b.price, 6) as y
      from t a join t b on a.currency = b.currency and b.pos = a.pos + 1""",
    "j3_with_stats": T
    + """select event_id, round(avg(price) over (partition by currency), 6) as price_mean,
             round(stddev_samp(price) over (partition by currency), 6) as price_sd from t""",
    "j4_missing_days": """
      with c as (select distinct event_type as currency from events),
      cal as (select currency, cast(unnest(range(date '2023-12-31', date '2024-02-01', interval 1 day)) as date) as d_ from c),
      pr as (select distinct event_type as currency, cast(ts as date) as d_ from events)
      select currency, d_ from cal anti join pr using (currency, d_)""",
    "m1_zscore": T
    + "select event_id, "
    + _feats("({c} - avg({c}) over (partition by currency)) / coalesce(nullif(stddev_samp({c}) over (partition by currency), 0), 1)", "_z")
    + " from t",
    "m2_zscore_split": T
    + """,
      s as (select *, case when pos < floor(n * cast(0.8 as double)) then 'train' else 'test' end as split from t)
      select event_id, split, """
    + _feats(
        "({c} - avg({c}) over (partition by currency, split)) / "
        "coalesce(nullif(stddev_pop({c}) over (partition by currency, split), 0), 1)",
        "_z",
    )
    + " from s",
    "m3_robust": T
    + """,
      q as (select currency, """
    + ", ".join(
        f"quantile_cont({c}, 0.5) as {c}_med, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) as {c}_iqr"
        for c in FEATS
    )
    + """ from t group by 1)
      select event_id, """
    + _feats("({c} - {c}_med) / coalesce(nullif({c}_iqr, 0), 1)", "_r")
    + " from t join q using (currency)",
    "m4_chain": T
    + "select event_id, "
    + _feats(
        "({c} - min({c}) over (partition by currency)) / coalesce(nullif(max({c}) over (partition by currency) "
        "- min({c}) over (partition by currency), 0), 1)",
        "_s",
    )
    + " from t",
    "m5_inverse": T
    + """,
      l as (select currency, event_id, ln(price + 1) as lp from t),
      mm as (select currency, min(lp) as lo, max(lp) as hi from l group by 1),
      s as (select event_id, (lp - lo) / coalesce(nullif(hi - lo, 0), 1) as sc, lo, hi from l join mm using (currency))
      select event_id, round(sc, 6) as price_scaled,
             round(exp(sc * coalesce(nullif(hi - lo, 0), 1) + lo) - 1, 6) as price_back from s""",
    "m7_hash_split": """
      select event_id, case when cast(('0x' || substr(md5(cast(event_id as varchar)), 1, 7)) as bigint) < 0.7 * 268435456
                            then 'train' else 'test' end as split from events""",
    "m16_daily_wide": """
      with d as (select event_type as currency, cast(ts as date) as d_, max_by(value, ts) as close
                 from events group by 1, 2),
      c as (select currency, d_, close / nullif(lag(close) over (partition by currency order by d_), 0) - 1 as chg from d)
      select d_, """
    + ", ".join(f"round(max(chg) filter (where currency = '{c}'), 6) as {c}" for c in ("click", "error", "purchase", "signup", "view"))
    + " from c group by 1",
    "m16_daily_sparse": """
      with d as (select event_type as currency, cast(ts as date) as d_, max_by(value, ts) as close
                 from events group by 1, 2),
      c as (select currency, d_, close / nullif(lag(close) over (partition by currency order by d_), 0) - 1 as chg from d)
      select d_, currency, (select count(distinct e.event_type) from events e where e.event_type < c.currency) as idx, round(chg, 6) as chg
      from c where chg is not null""",
    "m8_split_sizes": """
      with b as (select event_type as k, date_trunc('hour', ts) as t, max_by(value, (ts, event_id)) as close
                 from events where event_type in ('click', 'view') group by 1, 2),
      c as (select k, t, close / nullif(lag(close) over (partition by k order by t), 0) - 1 as chg from b),
      w as (select t, max(chg) filter (where k = 'click') as x, max(chg) filter (where k = 'view') as y from c group by 1),
      f as (select strftime(t, '%Y-%m-%d %H:%M:%S') as id, y > 0 as up from w where x is not null and y is not null),
      s as (select portion, up, cast('0x' || substr(md5(id), 1, 7) as bigint) < portion * 268435456.0 as train
            from f, (select unnest([0.5, 0.6, 0.7, 0.8, 0.9, 0.95])::double as portion))
      select portion, count(*) filter (train) as n_train, count(*) filter (not train) as n_test,
             count(*) filter (train and up) as up_train, count(*) filter (not train and up) as up_test
      from s group by 1""",
    "m17_label": """
      with d as (select event_type as currency, cast(ts as date) as d_, max_by(value, ts) as close
                 from events group by 1, 2),
      c as (select currency, d_, close / nullif(lag(close) over (partition by currency order by d_), 0) - 1 as chg from d)
      select currency, d_, cast(case when chg > 0 then 1 else 0 end as double) as move from c where chg is not null""",
    "prep_flagship": T
    + """,
      s as (select currency, pos // 12 - 1 as p, (n + 11) // 12 - 1 as m,
                   case when price + 1 > 0 then ln(price + 1) end as lp
            from t where pos % 12 = 0 and pos >= 12),
      mm as (select currency, min(lp) as lo, max(lp) as hi from s group by 1),
      sc as (select s.currency, p, m, (lp - lo) / coalesce(nullif(hi - lo, 0), 1) as y from s join mm using (currency)),
      wn as (select currency, p as w, m - 37 as nw from sc where p + 38 <= m),
      tg as (select wn.currency, wn.w, wn.nw, sc.y from wn join sc
             on sc.currency = wn.currency and sc.p between wn.w + 35 and wn.w + 37)
      select currency,
             case when w < floor(nw * cast(0.9 as double)) then 'train'
                  when w < floor(nw * cast(0.95 as double)) then 'val' else 'test' end as split,
             count(distinct w) as n_windows, round(avg(y), 6) as mean_target
      from tg group by 1, 2""",
    "a15_accuracy": """
      with d as (select event_type as currency, cast(ts as date) as d_, max_by(value, ts) as close
                 from events group by 1, 2),
      c as (select currency, d_, close / nullif(lag(close) over (partition by currency order by d_), 0) - 1 as chg from d),
      l as (select currency, d_, cast(case when chg > 0 then 1 else 0 end as double) as move from c where chg is not null),
      p as (select currency, move, lag(move) over (partition by currency order by d_) as prediction from l)
      select currency, round(avg(cast(prediction = move as double)), 6) as accuracy, count(*) as n
      from p where prediction is not null group by 1""",
    "m14_partition_sweep": """
      with s as (select round(corr(value, cast(json_extract_string(props, '$.k') as double)), 6) as corr,
                        count(*) as n, round(sum(cast(json_extract_string(props, '$.k') as double)), 6) as total,
                        round(avg(cast(json_extract_string(props, '$.k') as double)), 6) as average from events)
      select corr, n, total, average, cast(p as bigint) as partitions from s, (select unnest([1, 8, 18]) as p)""",
    "m18_prep": T
    + "select event_id, pos // 12 as pos, round(price, 6) as price from t where currency = 'click' and pos % 12 = 0",
    "s1_csv_round_trip": """
      select event_id, event_type as currency, ts as dt, round(value, 6) as price,
             round(cast(json_extract_string(props, '$.k') as double), 6) as volume from events""",
    "s2_json_round_trip": """
      select event_id, event_type as currency, ts as dt, round(value, 6) as price,
             round(cast(json_extract_string(props, '$.k') as double), 6) as volume from events""",
    "j5_score_join": PERSIST + "select currency, " + METRICS + " from s group by 1",
    "m6_fit_on_train": T
    + """,
      s as (select *, case when pos < floor(n * cast(0.8 as double)) then 'train' else 'test' end as split from t),
      mm as (select currency, min(price) as lo, max(price) as hi from s where split = 'train' group by 1)
      select event_id, split, round((price - lo) / coalesce(nullif(hi - lo, 0), 1), 6) as price_s
      from s join mm using (currency)""",
    "a11_rmse_usd": PERSIST
    + """,
      mm as (select currency, min(ln(price + 1)) as lo, max(ln(price + 1)) as hi from t group by 1)
      select currency, """
    + METRICS
    + """, round(sqrt(avg(pow((ln(predicted + 1) - ln(actual + 1)) / (hi - lo), 2))), 6) as rmse_scaled
      from s join mm using (currency) group by 1""",
    "s3_point_json": POINTS,
    "s7_ingest": POINTS,
    "s5_results": """
      with d as (select event_type as currency, cast(ts as date) as d_, avg(value) as v from events group by 1, 2),
      b as (select d_, v as base_v from d where currency = 'click'),
      c as (select d.currency as coin, round(corr(b.base_v, d.v), 6) as corr from d join b using (d_) group by 1)
      select coin, corr from c union all select coin, corr from c""",
    "s6_windows": H
    + """,
      wn as (select currency, p as window_id, m - 37 as nw from h where p + 38 <= m)
      select wn.currency, case when window_id < floor(nw * cast(0.9 as double)) then 'train'
                               when window_id < floor(nw * cast(0.95 as double)) then 'val' else 'test' end as split,
             wn.window_id, h.p - wn.window_id as h, round(h.price, 6) as v
      from wn join h on h.currency = wn.currency and h.p between wn.window_id and wn.window_id + 37""",
    "s8_html_rows": T
    + """,
      d as (select currency, cast(dt as date) as d_, arg_min(price, (dt, event_id)) as open, max(price) as high,
                   min(price) as low, arg_max(price, (dt, event_id)) as close, sum(volume) as value,
                   arg_max(market_cap, (dt, event_id)) as market_cap
            from t group by 1, 2)
      select currency, d_, try_cast(replace(format('{:,.2f}', open), ',', '') as double) as open, try_cast(replace(format('{:,.2f}', high), ',', '') as double) as high, try_cast(replace(format('{:,.2f}', low), ',', '') as double) as low, try_cast(replace(format('{:,.2f}', close), ',', '') as double) as close, try_cast(replace(format('{:,.2f}', value), ',', '') as double) as value, try_cast(replace(format('{:,.2f}', market_cap), ',', '') as double) as market_cap from d""",
}
SQL["w6_stored"] = SQL["w6_pct_change"]
