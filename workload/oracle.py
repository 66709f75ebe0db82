"""DuckDB statements for the queries, in the plainest form that is exact.

They follow the definitions (as-of joins of every member on the full grid, row by
row recursion for thinning), not the way the Spark side computes them.
"""

from __future__ import annotations

from workload import fixtures as fx

LOGS = {
    "events": """select event_type as fd_id, user_id as obj, epoch_us(ts)//1000000 as sec,
      epoch_us(ts) as ord1, event_id as ord2, cast(trunc(value*100+0.5) as bigint) as sz
      from events""",
    "lineitem": """select 'g' || (l_suppkey % 20) as fd_id, l_partkey as obj,
      epoch_us(l_shipdate)//86400000000 as sec, epoch_us(l_shipdate) as ord1,
      l_orderkey*10+l_linenumber as ord2, cast(trunc(l_quantity) as bigint) as sz
      from lineitem""",
}
LOGS["parts"] = f"""select 'c' || (l_partkey % {fx.BUNDLE_CLASSES}) as fd_id, l_suppkey as obj,
      epoch_us(l_shipdate)//86400000000 as sec, epoch_us(l_shipdate) as ord1,
      l_orderkey*10+l_linenumber as ord2, cast(trunc(l_quantity) as bigint) as sz
      from lineitem"""
UNITS = {"events": 1, "lineitem": fx.SECONDS_PER_DAY, "parts": fx.SECONDS_PER_DAY}
TRAFFIC = ["requests", "bytes", "tr_bytes", "tr_requests"]
VOLUMES = ["total_requests", "total_served_bytes", "total_mib", "peak_requests_300s",
           "peak_bytes_300s"]
UNIQUES = ["unique_objects", "unique_bytes"]


def _sum(x: str) -> str:
    return f"cast(sum({x}) as bigint)"


def _cut(x: str) -> str:
    return f"cast(trunc({x}) as bigint)"


def source(name: str, prefix: str = "", order: str = "ord1, ord2, sz") -> str:
    """CTEs ``fd`` (rows) and ``hd`` (headers) of a log."""
    p = prefix
    return f"""{p}log as ({LOGS[name]}),
{p}seqd as (select *, row_number() over w as k, sec - lag(sec) over w as iat
  from {p}log window w as (partition by fd_id, obj order by {order})),
{p}traf as (select fd_id, iat as delta_t,
    {_sum('case when k>=3 then 1 else 0 end')} as requests,
    {_sum('case when k>=3 then sz else 0 end')} as bytes,
    {_sum('case when k=2 then sz else 0 end')} as tr_bytes,
    {_sum('case when k=2 then 1 else 0 end')} as tr_requests
  from {p}seqd where k>=2 group by fd_id, iat),
{p}firsts as (select fd_id, obj, min(iat) as delta_t, max(sz) as osz from {p}seqd
  where k>=2 group by fd_id, obj),
{p}steps as (select fd_id, delta_t, count(*) as n, sum(osz) as s from {p}firsts
  group by fd_id, delta_t),
{p}fd as (select t.fd_id, t.delta_t,
    {_sum('coalesce(s.s,0)')[:-len(' as bigint)')]} over v as bigint) as mb,
    {_sum('coalesce(s.n,0)')[:-len(' as bigint)')]} over v as bigint) as objcount,
    t.requests, t.bytes, t.tr_bytes, t.tr_requests
  from {p}traf t left join {p}steps s on t.fd_id=s.fd_id and t.delta_t=s.delta_t
  window v as (partition by t.fd_id order by t.delta_t
               rows between unbounded preceding and current row)),
{p}hd as (select a.*, c.unique_objects, c.unique_bytes,
    b.peak_requests_300s, b.peak_bytes_300s
  from (select fd_id, cast(count(*) as bigint) as total_requests,
          {_sum('sz')} as total_served_bytes,
          cast((max(sec)-min(sec))*{UNITS[name]} as bigint) as duration,
          cast(sum(case when k=1 then sz else 0 end)//1000 as bigint) as total_mib
        from {p}seqd group by fd_id) a
  join (select fd_id, max(n) as peak_requests_300s, max(b) as peak_bytes_300s
        from (select fd_id, (sec*{UNITS[name]})//300 as slot, cast(count(*) as bigint) as n, {_sum('sz')} as b
              from {p}log group by 1, 2) group by fd_id) b on a.fd_id=b.fd_id
  join (select fd_id, cast(count(*) as bigint) as unique_objects, {_sum('s')} as unique_bytes
        from (select fd_id, obj, max(sz) as s from {p}log group by 1, 2) group by fd_id) c
    on a.fd_id=c.fd_id)"""


def values(rows: list[tuple], columns: list[str], doubles: tuple = ()) -> str:
    def lit(c, v):
        if isinstance(v, str):
            return f"'{v}'"
        return f"cast({v!r} as double)" if c in doubles else repr(v)

    body = ", ".join("(" + ", ".join(lit(c, v) for c, v in zip(columns, r)) + ")" for r in rows)
    return f"(select * from (values {body}) as v({', '.join(columns)}))"


def rule_values(*sets: list[tuple]) -> str:
    return values(
        [r[:8] for s in sets for r in s],
        ["mix_id", "ord", "fd_id", "op", "scale", "scale_type", "n", "m"],
        ("scale",),
    )


def mixing(
    rules: str, fd: str = "fd", hd: str = "hd", p: str = "", equalize: bool = False,
    merge: bool = False, single: bool = False,
) -> str:
    """CTEs ``mixfd`` and ``mixhd``: each member read off on the full grid of its mix."""
    real = "float" if single else "double"

    def frac(c):
        one = f"case when m>1 and n<>m then {_cut(f'cast({c} as {real})/cast(m as {real})')} else {c} end"
        return (f"case when m>1 and n<>m and n>1 then {_cut(f'cast(({one}) as {real})*cast(n as {real})')} "
                f"else {one} end")

    if merge:
        settled = ["max(mb) as mb", "max(objcount) as objcount"]
        settled += [f"{_sum(c)} as {c}" for c in TRAFFIC]
    else:
        settled = [f"arg_max({c}, t0) as {c}" for c in ["mb", "objcount"] + TRAFFIC]
    both = VOLUMES + UNIQUES
    eq = "r.duration" if equalize else "1"

    def total(x: str, share: str, top: str) -> str:
        if equalize:
            return f"cast(sum(cast({x} as hugeint)*{share})//max({top}) as bigint)"
        return _sum(x)

    def head_total(c: str) -> str:
        shared = c.startswith("total")
        return total("r." + c, eq, "r.duration") if shared else _sum("r." + c)

    return f"""{p}part as (select r.mix_id, r.ord, r.fd_id, r.op, r.scale, r.scale_type, r.n, r.m,
    h.duration, {', '.join(f'{frac("h."+c)} as {c}' for c in both)}
  from {rules} r join {hd} h on r.fd_id=h.fd_id),
{p}fac as (select *, (case when scale_type='traffic'
      then {'cast(scale as float)::double' if single else 'scale'}/cast((total_served_bytes*8)//duration as double)
      else {'cast(scale as float)::double' if single else 'scale'} end)
      * (case when op='sub' then -1 else 1 end) as f from {p}part),
{p}mem as (select * from (select mix_id, ord, fd_id, n, m, f, duration,
    {', '.join(f'{_cut(f"{c}*f")} as {c}' for c in VOLUMES)}, {', '.join(UNIQUES)} from {p}fac)
  where total_requests<>0),
{p}prep0 as (select m.mix_id, m.ord, m.duration, x.delta_t as t0,
    {_cut('x.delta_t/abs(m.f)')} as delta_t,
    {', '.join(f'{frac("x."+c)} as {c}' for c in ('mb', 'objcount'))},
    {', '.join(f'{_cut(f"({frac(chr(120)+chr(46)+c)})*m.f")} as {c}' for c in TRAFFIC)}
  from {p}mem m join {fd} x on x.fd_id=m.fd_id),
{p}prep as (select mix_id, ord, delta_t, any_value(duration) as duration,
    {', '.join(settled)}
  from {p}prep0 group by mix_id, ord, delta_t),
{p}grid as (select distinct mix_id, delta_t from {p}prep),
{p}heads as (select mix_id, ord, arg_min(mb, delta_t) as mb0,
    arg_min(objcount, delta_t) as objcount0 from {p}prep group by mix_id, ord),
{p}asof0 as (select g.mix_id, g.delta_t, h.ord, h.mb0, h.objcount0
  from {p}grid g join {p}heads h on g.mix_id=h.mix_id),
{p}asof1 as (select a.mix_id, a.delta_t, a.ord, coalesce(r.mb, a.mb0) as mb,
    coalesce(r.objcount, a.objcount0) as objcount
  from {p}asof0 a asof left join {p}prep r
    on a.mix_id=r.mix_id and a.ord=r.ord and a.delta_t>=r.delta_t),
{p}foot as (select mix_id, delta_t, {_sum('mb')} as mb, {_sum('objcount')} as objcount
  from {p}asof1 group by mix_id, delta_t),
{p}size as (select mix_id, count(*) as members, max(duration) as top from {p}mem group by mix_id),
{p}traffic as (select r.mix_id, r.delta_t,
    {', '.join(f'{total("r."+c, eq, "s.top")} as {c}' for c in TRAFFIC)}
  from {p}prep r join {p}size s on r.mix_id=s.mix_id group by r.mix_id, r.delta_t),
{p}mixfd as (select f.mix_id as fd_id, f.delta_t, f.mb, f.objcount, {', '.join(TRAFFIC)}
  from {p}foot f join {p}traffic t on f.mix_id=t.mix_id and f.delta_t=t.delta_t
  join {p}size s on s.mix_id=f.mix_id
  where s.members=1 or requests<>0 or bytes<>0 or tr_bytes<>0 or tr_requests<>0),
{p}mixhd as (select mix_id as fd_id,
    {', '.join(f'{head_total(c)} as {c}' for c in VOLUMES)},
    cast(max(duration) as bigint) as duration,
    {', '.join(f'{_sum(c)} as {c}' for c in UNIQUES)}
  from {p}mem r group by mix_id)"""


def chained(mix_id: str, members: int) -> str:
    """CTEs ``s1`` .. ``sN``: the prepared members of one mix added two at a time."""
    cols = ["mb", "objcount"]
    parts = [f"s1 as (select * from prep where mix_id='{mix_id}' and ord=0)"]
    for k in range(1, members):
        a, b = f"s{k}", f"m{k}"
        parts.append(f"{b} as (select * from prep where mix_id='{mix_id}' and ord={k})")
        parts.append(f"g{k} as (select delta_t from {a} union select delta_t from {b})")

        def side(t):
            return (f"select g.delta_t, coalesce(x.mb, h.mb) as mb, "
                    f"coalesce(x.objcount, h.objcount) as objcount, "
                    + ", ".join(f"case when x.delta_t=g.delta_t then x.{c} else 0 end as {c}"
                                for c in TRAFFIC)
                    + f" from g{k} g asof left join {t} x on g.delta_t>=x.delta_t "
                    f"cross join (select arg_min(mb, delta_t) as mb, "
                    f"arg_min(objcount, delta_t) as objcount from {t}) h")

        parts.append(f"s{k + 1} as (select u.delta_t, "
                     + ", ".join(f"u.{c}+v.{c} as {c}" for c in cols + TRAFFIC)
                     + f" from ({side(a)}) u join ({side(b)}) v on u.delta_t=v.delta_t where "
                     + " or ".join(f"u.{c}+v.{c}<>0" for c in TRAFFIC) + ")")
    return ", ".join(parts)


ROWS = "fd_id, delta_t, mb, objcount, requests, bytes, tr_bytes, tr_requests"
HEADER = ("fd_id, total_requests, total_served_bytes, duration, total_mib, unique_objects, "
          "unique_bytes, peak_requests_300s, peak_bytes_300s")
EVENTS = "with recursive " + source("events")
LINES = "with recursive " + source("lineitem")


def curve(axis: str, fd: str = "fd", hd: str = "hd", icp: bool = False, where: str = "true") -> str:
    r = "requests + tr_requests" if icp else "requests"
    b = "bytes + tr_bytes" if icp else "bytes"
    return f"""select p.fd_id, p.{axis}, p.r as requests, p.r*100.0::double/h.total_requests
    as request_pct, p.b - h.total_mib as bytes,
    (p.b - h.total_mib)*100.0::double/h.total_served_bytes as byte_pct
  from (select fd_id, {axis}, cast(sum(r) over v as bigint) as r, cast(sum(b) over v as bigint) as b
        from (select fd_id, {axis}, sum({r}) as r, sum({b}) as b from {fd} where {where}
              group by fd_id, {axis})
        window v as (partition by fd_id order by {axis})) p
  join {hd} h on p.fd_id=h.fd_id"""


def scaled(fd: str, factor: str, merge: bool) -> str:
    agg = (
        ["max(mb) as mb", "max(objcount) as objcount"]
        + [f"{_sum(_cut(f'{c}*({factor})'))} as {c}" for c in TRAFFIC]
        if merge
        else ["arg_max(mb, delta_t) as mb", "arg_max(objcount, delta_t) as objcount"]
        + [f"arg_max({_cut(f'{c}*({factor})')}, delta_t) as {c}" for c in TRAFFIC]
    )
    return (f"select fd_id, {_cut(f'delta_t/abs({factor})')} as delta_t, {', '.join(agg)} "
            f"from {fd} group by fd_id, 2")


def per_amount(expr: str, also: str = "") -> str:
    cols = ["mb", "objcount"] + TRAFFIC
    return (f"select fd_id, delta_t, {', '.join(f'{expr.format(c=c)} as {c}' for c in cols)} "
            f"from fd{also}")


MIXES = [fx.HALF_ALL, fx.MIXED_OPS]


def _spread(axis: str, step: int, name: str) -> str:
    return f"""probes as (select e.event_type as fd_id, (e.event_id*{step}) % (x.top + x.top//16 + 2) as {name}
  from events e join (select fd_id, max({axis}) as top from fd group by fd_id) x on x.fd_id=e.event_type)"""


IAT_PROBES = _spread("delta_t", 7919, "t")
MB_PROBES = _spread("mb", 104729, "target")


def floor_lookup(rows: str, axis: str, probe: str, payload: list[str]) -> str:
    return f"""select p.fd_id, p.{probe}, coalesce(r.{axis}, h.{axis}) as {axis},
    {', '.join(f'coalesce(r.{c}, h.{c}) as {c}' for c in payload)}
  from probes p asof left join {rows} r on p.fd_id=r.fd_id and p.{probe}>=r.{axis}
  join (select fd_id, {', '.join(f'arg_min({c}, {axis}) as {c}' for c in [axis] + payload)}
        from {rows} group by fd_id) h on h.fd_id=p.fd_id"""


FULL = ["mb", "objcount"] + TRAFFIC
#: Sizes as parts (n / of, and some more) of the largest footprint, rising.
PARTS = [(1, 40, 0), (1, 20, 0), (1, 20, 1), (1, 8, 0), (1, 4, 0), (25, 1, 0)]
_LARGEST = "(select max(mb) from fd)"


def _size(n: int, of: int, more: int) -> str:
    return f"({_LARGEST}*{n}//{of} + {more})"


SIZES = [_size(*p) for p in PARTS]


def marker_cte(sizes: list[str]) -> str:
    """Markers one after the other, sizes rising: each takes the next row above its size."""
    ranked = ("rk as (select fd_id, delta_t, mb, row_number() over (partition by fd_id "
              "order by delta_t) as n from fd),\n"
              "ends as (select fd_id, max(n) as n_max from rk group by fd_id)")
    parts, previous = [ranked], None
    for j, c in enumerate(sizes):
        after = f"and r.n > coalesce(q.n, 0)" if previous else ""
        join = f"left join {previous} q on q.fd_id=r.fd_id" if previous else ""
        parts.append(
            f"mk{j} as (select e.fd_id, x.n from ends e left join (select r.fd_id, min(r.n) as n "
            f"from rk r {join} where r.mb > {c} {after} group by r.fd_id) x on x.fd_id=e.fd_id)"
        )
        previous = f"mk{j}"
    union = " union all ".join(
        f"select m.fd_id, cast({c} as bigint) as marker_mb, r.delta_t from mk{j} m "
        f"join ends e on e.fd_id=m.fd_id join rk r on r.fd_id=m.fd_id and "
        f"r.n=coalesce(m.n, e.n_max)" for j, c in enumerate(sizes)
    )
    return ",\n".join(parts) + f",\nmk as ({union})"


def quick_add_sql(c: str) -> str:
    groups = values(fx.SHARED_CACHE, ["mix_id", "fd_id"])
    return f"""{EVENTS}, {marker_cte([c])},
grp as {groups},
size as (select mix_id, count(*) as members, {_sum('h.total_served_bytes')} as served,
    {_sum('h.total_mib')} as mib from grp g join hd h on h.fd_id=g.fd_id group by mix_id),
cum as (select *, cast(sum(bytes) over (partition by fd_id order by delta_t) as bigint) as cb
  from fd),
half as (select fd_id, coalesce(max(case when mb <= ({c}//2) then delta_t end), min(delta_t))
  as t from fd group by fd_id),
lim as (select g.mix_id, min(h.t) as lt, min(m.delta_t) as rt from grp g
  join half h on h.fd_id=g.fd_id join mk m on m.fd_id=g.fd_id group by g.mix_id),
grid as (select distinct g.mix_id, f.delta_t from grp g join fd f on f.fd_id=g.fd_id
  union select mix_id, lt from lim),
head as (select fd_id, arg_min(mb, delta_t) as mb0, arg_min(cb, delta_t) as cb0 from cum
  group by fd_id),
points as (select g.mix_id, g.delta_t, x.fd_id, h.mb0, h.cb0 from grid g
  join grp x on x.mix_id=g.mix_id join head h on h.fd_id=x.fd_id),
seen as (select p.mix_id, p.delta_t, {_sum('coalesce(c.mb, p.mb0)')} as mb,
    {_sum('coalesce(c.cb, p.cb0)')} as cb
  from points p asof left join cum c on p.fd_id=c.fd_id and p.delta_t>=c.delta_t
  group by p.mix_id, p.delta_t),
nxt as (select *, lead(delta_t) over (partition by mix_id order by delta_t) as nt from seen),
best as (select n.mix_id, max(n.delta_t) as t from nxt n join lim l on l.mix_id=n.mix_id
  where n.delta_t>=l.lt and n.delta_t<l.rt and n.mb<={c} group by n.mix_id)
select s.mix_id, cast({c} as bigint) as cache_mb, n.cb - s.mib as hit_bytes,
  s.served as served_bytes,
  case when b.t is null then l.lt else least(n.nt, l.rt) - 1 end as iat
from size s join lim l on l.mix_id=s.mix_id left join best b on b.mix_id=s.mix_id
join nxt n on n.mix_id=s.mix_id and n.delta_t=coalesce(b.t, l.lt) where s.members>1
union all
select s.mix_id, cast({c} as bigint), c.cb - h.total_mib, h.total_served_bytes, m.delta_t
from size s join grp g on g.mix_id=s.mix_id join mk m on m.fd_id=g.fd_id
join cum c on c.fd_id=m.fd_id and c.delta_t=m.delta_t join hd h on h.fd_id=g.fd_id
where s.members=1"""


def concat_sql(weighted: bool, cmax: str, ghosts: int, headers: bool = False) -> str:
    rules = values(fx.CONCAT, ["concat_id", "ord", "fd_id", "scale"], ("scale",))
    w = _cut("h.total_served_bytes*r.scale") if weighted else "1"
    base = f"""{EVENTS}, rl as {rules},
cr as (select * from rl where concat_id not in
  (select concat_id from rl where fd_id not in (select fd_id from hd))),
ch as (select r.concat_id, r.ord, h.duration, h.unique_objects, h.unique_bytes,
    cast({w} as hugeint) as w,
    {', '.join(f'{_cut(f"h.{c}*r.scale")} as {c}' for c in VOLUMES)}
  from cr r join hd h on h.fd_id=r.fd_id),
rd as (select r.concat_id, r.ord, {_cut('f.delta_t*r.scale')} as delta_t,
    arg_max(f.mb, f.delta_t) as mb,
    {', '.join(f'{_sum(_cut(f"f.{c}*r.scale"))} as {c}' for c in TRAFFIC)}
  from cr r join fd f on f.fd_id=r.fd_id group by r.concat_id, r.ord, 3),
per as (select concat_id, ord, mb, sum(delta_t) as ts, count(*) as tc,
    {', '.join(f'{_sum(c)} as {c}' for c in TRAFFIC)}
  from rd {f'where mb <= {cmax}' if cmax else ''} group by concat_id, ord, mb),
mx as (select concat_id, ord, max(mb) as mx from rd group by concat_id, ord),
sizes as (select distinct concat_id, mb from per),
pts as (select s.concat_id, s.mb, m.ord, m.mx, h.w from sizes s
  join mx m on m.concat_id=s.concat_id join ch h on h.concat_id=m.concat_id and h.ord=m.ord),
look as (select p.*, q.mb as at_mb, q.ts, q.tc, q.requests, q.bytes, q.tr_bytes, q.tr_requests
  from pts p asof left join per q on p.concat_id=q.concat_id and p.ord=q.ord and p.mb>=q.mb),
avgd as (select concat_id, mb, sum(case when ts is null then 0 else w*(ts//tc) end) as whole,
    sum(case when at_mb=mb then w::double*(ts-(ts//tc)*tc)/tc else 0 end) as part,
    sum(case when ts is null then 0 else w end) as weights,
    {_sum('least(mb, mx)')} as mb_out,
    {', '.join(f'{_sum(f"case when at_mb=mb then {c} else 0 end")} as {c}' for c in TRAFFIC)}
  from look group by concat_id, mb)"""
    if headers:
        return f"""{base} select concat_id as fd_id,
  {', '.join(f'{_sum(c)} as {c}' for c in VOLUMES)}, cast(max(duration) as bigint) as duration,
  {', '.join(f'cast(sum({c})//{ghosts} as bigint) as {c}' for c in UNIQUES)}
from ch group by concat_id"""
    return f"""{base}
select concat_id as fd_id, delta_t, arg_max(mb_out, mb) as mb, cast(0 as bigint) as objcount,
  {', '.join(f'{_sum(c)} as {c}' for c in TRAFFIC)}
from (select *, {_cut('(whole::double+part)/weights::double')} as delta_t from avgd)
group by concat_id, delta_t"""


def thin_sql(pct: float, base: str = "", fd: str = "fd") -> str:
    base = base or LINES
    moved = (f"(case when w.pt=0 then x.delta_t<>0 else abs((x.delta_t-w.pt)*100.0::double/w.pt)"
             f">={pct} end or case when w.pm=0 then x.mb<>0 else "
             f"abs((x.mb-w.pm)*100.0::double/w.pm)>={pct} end)")
    s = ", ".join(f"case when {moved} then 0 else w.s_{c}+x.{c} end" for c in TRAFFIC)
    o = ", ".join(f"w.s_{c}+x.{c}" for c in TRAFFIC)
    names = ", ".join([f"s_{c}" for c in TRAFFIC] + [f"o_{c}" for c in TRAFFIC])
    if pct > 100:  # no first row is kept, so none after it
        return f"""{base} select fd_id, max(delta_t) as delta_t, arg_max(mb, delta_t) as mb,
  arg_max(objcount, delta_t) as objcount, {', '.join(f'{_sum(c)} as {c}' for c in TRAFFIC)}
from {fd} group by fd_id having sum(requests)>0 and max(delta_t)<>0"""
    return f"""{base},
num as (select *, row_number() over (partition by fd_id order by delta_t) as i from {fd}),
walk(fd_id, i, delta_t, mb, objcount, pt, pm, kept, {names}) as (
  select fd_id, i, delta_t, mb, objcount, delta_t, mb, true, {', '.join(['0::bigint'] * 4)},
    {', '.join(TRAFFIC)} from num where i=1
  union all
  select x.fd_id, x.i, x.delta_t, x.mb, x.objcount,
    case when {moved} then x.delta_t else w.pt end, case when {moved} then x.mb else w.pm end,
    {moved}, {s}, {o}
  from walk w join num x on x.fd_id=w.fd_id and x.i=w.i+1),
ends as (select fd_id, max(i) as i from num group by fd_id)
select w.fd_id, w.delta_t, w.mb, w.objcount, {', '.join(f'w.o_{c} as {c}' for c in TRAFFIC)}
from walk w join ends e on e.fd_id=w.fd_id
where w.kept or (w.i=e.i and w.o_requests>0)"""


THIN_PCT = 4.0


def file_statements(sql: dict[str, str]) -> dict[str, str]:
    """Statements of the queries in ``workload.files``."""
    doubled = ", ".join(f"2*{c} as {c}" for c in TRAFFIC)
    digit = "(cast(round_even({}, 1) as double) + 0.0::double)"
    curve_row = "fd_id, {a}, requests, " + digit.format("request_pct") + " as request_pct, bytes, "
    curve_row += digit.format("byte_pct") + " as byte_pct"
    n = "cast(substr(fd_id, 2) as integer)"
    kind = "s_suppkey % 5"
    return {
        "read_shards": f"{LINES} select fd_id, delta_t, mb, objcount, {doubled} from fd",
        "read_rejects": f"""{LINES} select fd_id, case {n} when 0 then 'bad header' when 1 then
  'no traffic' when 2 then 'bad line' when 3 then 'no body' when 4 then 'bad header' end as reason
  from hd where {n} < 5""",
        "read_key_names": f"{LINES} select fd_id, case when {n} % 2 = 0 then cast({n} as varchar) "
                          f"else '1' end as key_index from hd",
        "curve_files_space": f"{EVENTS}, crv as ({curve('mb')}) select {curve_row.format(a='mb')} from crv",
        "curve_files_count": f"{LINES}, crv as ({curve('objcount')}) select "
                             f"{curve_row.format(a='objcount')} from crv",
        "mix_rules_parsed": f"""select 'm' || (s_suppkey % 3) as mix_id,
  cast(row_number() over (partition by s_suppkey % 3 order by s_suppkey) - 1 as integer) as ord,
  'g' || s_nationkey as fd_id, case when {kind} = 1 then 'sub' else 'add' end as op,
  cast(case {kind} when 0 then 0.5 when 1 then 2e9 when 2 then 3e6 else 1.5 end as double) as scale,
  case when {kind} in (1, 2) then 'traffic' else 'absolute' end as scale_type,
  cast(case when {kind} = 2 then 2 else 0 end as integer) as num_shards,
  cast(case when {kind} = 2 then 16 else 0 end as integer) as total_shards,
  cast(case when {kind} = 3 then 100 else 0 end as bigint) as max_mb,
  cast(case when {kind} = 3 then 5 else 0 end as bigint) as min_mb,
  cast(case when {kind} = 3 then 7 else 0 end as bigint) as max_count,
  cast(case when {kind} = 3 then 2 else 0 end as bigint) as min_count
  from supplier where {kind} <> 4 and s_suppkey % 7 <> 0""",
        "mix_rules_rejects": """select 'bad' as mix_id, 'g' || s_nationkey ||
  case when s_suppkey % 2 = 0 then ' multiply 2' else ' add much' end as value,
  case when s_suppkey % 2 = 0 then 'bad action' else 'bad scale' end as reason
  from supplier where s_suppkey % 7 = 0""",
        "concat_rules_parsed": """select 'all' as concat_id,
  cast(row_number() over (order by s_suppkey) - 1 as integer) as ord, 'g' || s_nationkey as fd_id,
  cast(s_suppkey as double) / 4 as scale from supplier""",
        "preview": f"{LINES} select {HEADER} from hd order by total_served_bytes, fd_id limit 5",
        "unshard_job": sql["unshard"],
        "t2s_job": f"{EVENTS} {curve('mb')}",
        "t2c_job": f"{LINES} {curve('objcount')}",
        "concat_job": f"select * from ({concat_sql(False, '', 1)}) where fd_id = 'three'",
        "flat_files": f"{LINES} select {ROWS} from fd where fd_id like 'g1%'",
        "mix_job_faults": "select name, reason from " + values(
            [("click", "superseded"), ("g0", "bad header"), ("g1", "no traffic"), ("g2", "bad line"),
             ("g3", "no body"), ("bad", "bad action"), ("job/absent", "no such descriptor"),
             ("job/purchase", "zero_scale"), ("job/g6", "no_rate"), ("job/error", "empty")], ["name", "reason"]),
        "mix_job_customer_map": f"""{EVENTS}, names as (select n_nationkey as k,
  ['click', 'view', 'error', 'signup', 'purchase', null][n_nationkey%6 + 1] as fd_id from nation),
rl as (select case when fd_id in ('click', 'view') then 'a' else 'b^x' end as mix_id, k as ord, fd_id,
  'add' as op, cast(1 as double) as scale, 'absolute' as scale_type, 0 as n, 0 as m
  from names where fd_id is not null), {mixing('rl')} select {ROWS} from mixfd""",
        "mix_job_glob_thinned": thin_sql(THIN_PCT, f"""{EVENTS}, {mixing(rule_values(*[
            [fx.rule(m, i, c, scale=x) for i, c in enumerate(fx.EVENT_CLASSES)]
            for m, x in (("half.mg", 0.5), ("one.mg", 1.0))]))}""", "mixfd"),
        "mix_job": f"{EVENTS}, {mixing(rule_values(fx.JOB_RULES[:-1]))} select {ROWS} from mixfd",
        "mix_job_failures": f"""{EVENTS} select mix_id || '/' || fd_id as name,
  case when fd_id in (select fd_id from hd) then 'zero_scale' else 'no such descriptor' end as reason
  from {rule_values(fx.JOB_RULES)} r where scale = 0 or fd_id not in (select fd_id from hd)""",
    }


QUOTA_WHERE = f"mb <= {_LARGEST}*2//5 and objcount >= 3"
LIMIT = f"mb <= {_LARGEST}*3//10"
FLOOR = "objcount >= 5"


def quota_sql(limit: str, floor: str) -> str:
    return f"""{EVENTS}, {IAT_PROBES},
low as (select *, row_number() over (partition by fd_id order by delta_t) as i from fd),
spot as ({floor_lookup('low', 'delta_t', 't', ['i'])}),
ok as (select * from low where {limit}),
b as (select s.fd_id, s.t, coalesce(o.i, 1) as i from spot s
  asof left join ok o on s.fd_id=o.fd_id and s.i>=o.i),
up as (select * from low where {floor}),
a as (select b.fd_id, b.t, coalesce(u.i, z.i) as i from b
  asof left join up u on b.fd_id=u.fd_id and b.i<=u.i
  join (select fd_id, max(i) as i from low group by fd_id) z on z.fd_id=b.fd_id)
select a.fd_id, a.t, l.delta_t, {', '.join('l.' + c for c in FULL)}
from a join low l on l.fd_id=a.fd_id and l.i=a.i"""


def footprint_sql(name: str) -> str:
    """Mean footprints from every gap of every object, for every reuse time."""
    return f"""with recursive {source(name)},
span as (select fd_id, min(sec) as s0, max(sec) as s1 from log group by fd_id),
ob as (select fd_id, obj, min(sec) as t0, max(sec) as t1, max(sz) as size from log group by fd_id, obj),
gap as (select o.fd_id, o.t0-s.s0+1 as g, o.size from ob o join span s on s.fd_id=o.fd_id
  union all select o.fd_id, s.s1-o.t1+1, o.size from ob o join span s on s.fd_id=o.fd_id
  union all select q.fd_id, q.iat, o.size from seqd q join ob o on o.fd_id=q.fd_id and o.obj=q.obj where q.k>=2),
hist as (select fd_id, g, cast(count(*) as hugeint) as n, cast(sum(size) as hugeint) as s from gap group by fd_id, g),
w as (select distinct fd_id, iat as w from seqd where k>=2),
miss as (select w.fd_id, w.w, coalesce(sum((h.g-w.w)*h.n), 0) as n, coalesce(sum((h.g-w.w)*h.s), 0) as s
  from w left join hist h on h.fd_id=w.fd_id and h.g>w.w group by w.fd_id, w.w),
whole as (select fd_id, count(*) as n, sum(size) as s from ob group by fd_id)
select m.fd_id, m.w as delta_t,
  cast((t.s*(p.s1-p.s0+2-m.w) - m.s)//(p.s1-p.s0+2-m.w) as bigint) as mb,
  cast((t.n*(p.s1-p.s0+2-m.w) - m.n)//(p.s1-p.s0+2-m.w) as bigint) as objcount
from miss m join whole t on t.fd_id=m.fd_id join span p on p.fd_id=m.fd_id"""


def bundle_rules() -> str:
    """Rules of the bundled shape but for the mix of groups."""
    g, n = fx.BUNDLE_GROUPS, fx.BUNDLE_CLASSES
    tail = "'absolute' as scale_type, 0 as n, 0 as m"
    parts = [f"select 'g' || (i%{g}) || '.mg1' as mix_id, i as ord, 'c' || i as fd_id, 'add' as op, "
             f"cast(1 as double) as scale, {tail} from range({n}) t(i)"]
    parts += [f"select 'g' || ((i*{k}+{k})%{g}) || '.mg2', i + {k * n}, 'c' || i, 'add', cast(0.5 as double), {tail} "
              f"from range({n}) t(i)" for k in (3, 7)]
    return f"({' union all '.join(parts)})"


def statements() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["fd_from_events"] = f"{EVENTS} select {ROWS} from fd"
    sql["fd_from_lineitem"] = f"{LINES} select {ROWS} from fd"
    sql["fd_headers"] = (f"{EVENTS}, {source('lineitem', 'l_')} select {HEADER} from hd "
                         f"union all select {HEADER} from l_hd")
    sql["scale_absolute"] = f"{EVENTS} {scaled('fd', '2.0::double', False)}"
    sql["scale_collision_merge"] = f"{LINES} {scaled('fd', '3.0::double', True)}"
    bps = "(x.f)"
    traffic = ("(select fd.*, 50.0::double/cast((hd.total_served_bytes*8)//hd.duration as double)"
               " as f from fd join hd on hd.fd_id=fd.fd_id) x")
    sql["scale_to_traffic"] = f"{EVENTS} {scaled(traffic, bps, False)}"
    sql["shard"] = f"{EVENTS} {per_amount(_cut('{c}/3.0::double'))}"
    sql["unshard"] = f"{EVENTS} {per_amount(_cut('{c}*2.5::double'))}"
    sql["shard_fraction"] = (
        f"{EVENTS} {per_amount(_cut(_cut('{c}/7.0::double') + '*3.0::double'))}"
    )
    for name, sets in {
        "subtract": [fx.SUBTRACT], "add_two": [fx.PAIR],
        "mix_nway": [fx.HALF_ALL, fx.ONE_ALL, fx.MIXED_OPS],
    }.items():
        sql[name] = f"{EVENTS}, {mixing(rule_values(*sets))} select {ROWS} from mixfd"
    every = [fx.HALF_ALL, fx.ONE_ALL, fx.MIXED_OPS, fx.SUBTRACT]
    plain = ", ".join(["mix_id", "ord", "delta_t", *FULL])
    sql["prepared_members"] = f"{EVENTS}, {mixing(rule_values(*MIXES))} select {plain} from prep"
    sql["mix_merged_collisions"] = (
        f"{LINES}, {mixing(rule_values(fx.SHRUNK), merge=True)} select {ROWS} from mixfd")
    sql["mix_in_rule_order"] = (
        f"{EVENTS}, {mixing(rule_values(fx.HALF_ALL))}, {chained('half_all', 5)} "
        f"select 'half_all' as fd_id, {', '.join(['delta_t', *FULL])} from s5")
    sql["mix_order_cancelling"] = (
        f"{EVENTS}, {mixing(rule_values(fx.CANCELLING))}, {chained('cancelling', 4)} "
        f"select 'cancelling' as fd_id, {', '.join(['delta_t', *FULL])} from s4")
    stretched = "604800.0::double/duration"
    rate = "50.0::double/cast((total_served_bytes*8)//duration as double)"
    for name, change, kinds in (
        ("scale_absolute", "{c}*2.0::double", VOLUMES),
        ("scale_to_traffic", "{c}*(" + rate + ")", VOLUMES),
        ("shard", "{c}/3.0::double", VOLUMES + UNIQUES),
        ("unshard", "{c}*2.5::double", VOLUMES + UNIQUES),
        ("shard_fraction", _cut("{c}/7.0::double") + "*3.0::double", VOLUMES + UNIQUES),
        ("stretch_duration", "{c}*(" + stretched + ")", VOLUMES),
        ("split_virtual", "{c}//4", VOLUMES),
    ):
        parts = [f"{_cut(change.format(c=c))} as {c}" if c in kinds else c for c in VOLUMES + UNIQUES]
        length = "cast(604800 as bigint) as duration" if name == "stretch_duration" else "duration"
        sql[f"{name}_headers"] = f"{EVENTS} select fd_id, {length}, {', '.join(parts)} from hd"
    sql |= file_statements(sql)
    sql["text_round_trip"] = f"{LINES} select {ROWS} from fd"
    sql["fd_from_stream"] = (f"with {source('events', order='sec, sz')} select {ROWS} from fd")
    sql["footprint_events"], sql["footprint_lineitem"] = footprint_sql("events"), footprint_sql("lineitem")
    flat = [fx.rule("flat", i, f"g{i}.mg1") for i in range(fx.BUNDLE_GROUPS)]
    sql["mix_bundle"] = (
        f"with recursive {source('parts')}, {mixing(bundle_rules(), p='a_')}, "
        f"{mixing(rule_values(flat), 'a_mixfd', 'a_mixhd', 'b_')} select {ROWS} from a_mixfd "
        f"union all select {ROWS} from b_mixfd")
    sql["bundle_missing"] = "select 'gone.mg1' as name"
    sql["mix_float32"] = (f"{EVENTS}, {mixing(rule_values(fx.TENTH), single=True)} select {ROWS} from mixfd")
    sql["unshard_float32"] = f"{EVENTS} {per_amount(_cut('cast({c} as float)*2.5::float'))}"
    sql["mix_equalized_headers"] = (f"{EVENTS}, {mixing(rule_values(fx.ONE_ALL), equalize=True)} "
                                    f"select {HEADER} from mixhd")
    sql["mix_headers"] = f"{EVENTS}, {mixing(rule_values(*every))} select {HEADER} from mixhd"
    sql["mix_equalized"] = (f"{EVENTS}, {mixing(rule_values(fx.ONE_ALL), equalize=True)} "
                            f"select {ROWS} from mixfd")
    sql["mix_hierarchical"] = (
        f"{LINES}, {mixing(rule_values(fx.GROUPS), p='a_')}, "
        f"{mixing(rule_values(fx.FLAT), 'a_mixfd', 'a_mixhd', 'b_')} select {ROWS} from b_mixfd"
    )
    sql["mixed_space_curve"] = (f"{EVENTS}, {mixing(rule_values(fx.HALF_ALL))} "
                                f"{curve('mb', 'mixfd', 'mixhd')}")
    sql["t2s"] = f"{EVENTS} {curve('mb')}"
    sql["t2c"] = f"{LINES} {curve('objcount')}"
    sql["t2s_icp"] = f"{LINES} {curve('mb', icp=True)}"
    sql["t2c_icp"] = f"{EVENTS} {curve('objcount', icp=True)}"
    sql["t2s_quota"] = f"{EVENTS} {curve('mb', where=QUOTA_WHERE)}"
    sql["thin"] = thin_sql(THIN_PCT)
    sql["thin_0"] = f"{LINES} select {ROWS} from fd"
    sql["thin_100"] = thin_sql(100.0)
    sql["thin_150"] = thin_sql(150.0)
    sql["cum_bytes"] = (f"{EVENTS} select {ROWS}, cast(sum(bytes) over (partition by fd_id "
                        f"order by delta_t) as bigint) as cum_bytes from fd")
    sql["asof_lookup"] = f"{EVENTS}, {IAT_PROBES} {floor_lookup('fd', 'delta_t', 't', FULL)}"
    sql["matching_lookup"] = (
        f"{EVENTS}, {IAT_PROBES}, found as ({floor_lookup('fd', 'delta_t', 't', FULL)}) "
        f"select fd_id, t, delta_t, mb, objcount, "
        + ", ".join(f"case when t=delta_t then {c} else 0 end as {c}" for c in TRAFFIC)
        + " from found"
    )
    sql["asof_quota"] = quota_sql(LIMIT, FLOOR)
    sql["asof_quota_unset_is_zero"] = quota_sql(f"{LIMIT} and objcount <= 0", f"{FLOOR} and mb >= 0")
    sql["matching_quota"] = "select fd_id, t, delta_t, mb, objcount, " + ", ".join(
        f"case when t=delta_t then {c} else 0 end as {c}" for c in TRAFFIC
    ) + f" from ({quota_sql(LIMIT, FLOOR)})"
    sql["stack_distance_at"] = (f"{EVENTS}, {IAT_PROBES} select fd_id, t, mb from "
                                f"({floor_lookup('fd', 'delta_t', 't', FULL)})")
    sql["iat_for_mb"] = f"""{EVENTS}, {MB_PROBES},
top as (select fd_id, mb, max(delta_t) as delta_t from fd group by fd_id, mb),
runmax as (select fd_id, mb, max(delta_t) over (partition by fd_id order by mb) as delta_t from top)
select p.fd_id, p.target as target_mb, coalesce(r.delta_t, l.delta_t) as delta_t
from probes p asof left join runmax r on p.fd_id=r.fd_id and p.target>=r.mb
join (select fd_id, min(delta_t) as delta_t from fd group by fd_id) l on l.fd_id=p.fd_id"""
    sql["iats_with_mb"] = f"""{LINES}, asked as (select distinct 'g' || (p_partkey % 20) as fd_id,
  ((p_partkey*7)//20 % 500)*10 as mb from part)
select f.fd_id, f.mb, f.delta_t from fd f join asked a on a.fd_id=f.fd_id and a.mb=f.mb"""
    sql["iats_index"] = sql["iats_with_mb"]
    sql["stack_distances"] = f"{LINES} select distinct fd_id, mb from fd"
    sql["markers"] = f"{EVENTS}, {marker_cte(SIZES)} select * from mk"
    sql["quick_add"] = quick_add_sql(f"({_LARGEST}//3)")
    fifth = f"({_LARGEST}//5)"
    sql["quick_lookup"] = f"""{EVENTS}, {marker_cte([fifth])},
cum as (select *, cast(sum(bytes) over (partition by fd_id order by delta_t) as bigint) as cb
  from fd)
select m.fd_id, cast({fifth} as bigint) as cache_mb, c.cb-h.total_mib as hit_bytes,
  h.total_served_bytes as served_bytes, m.delta_t as iat
from mk m join cum c on c.fd_id=m.fd_id and c.delta_t=m.delta_t join hd h on h.fd_id=m.fd_id"""
    sql["concat"] = concat_sql(False, "", 1)
    sql["concat_weighted"] = concat_sql(True, "", 1)
    sql["concat_limited"] = concat_sql(False, "(select max(mb)//2 from fd)", 1)
    sql["concat_headers"] = concat_sql(False, "", 2, headers=True)
    size_probe = MB_PROBES.replace("target", "cache_mb")
    space = f"crv as ({curve('mb')})"
    sql["curve_lookup"] = (f"{EVENTS}, {space}, {size_probe} "
                           f"{floor_lookup('crv', 'mb', 'cache_mb', ['requests', 'bytes'])}")
    sql["hit_rate_at"] = (
        f"{EVENTS}, {space}, {size_probe}, "
        f"found as ({floor_lookup('crv', 'mb', 'cache_mb', ['requests', 'bytes'])}) "
        f"select f.fd_id, f.cache_mb, f.bytes*100.0::double/h.total_served_bytes as byte_hit_pct "
        f"from found f join hd h on h.fd_id=f.fd_id"
    )
    sql["max_hit_rate"] = (f"{LINES}, {space} select fd_id, arg_max(byte_pct, mb) as max_hit_rate "
                           f"from crv group by fd_id")
    sql["size_for_hit_rate"] = f"""{EVENTS}, {space},
asked as (select event_type as fd_id, cast(event_id % 1000 as double)/10.0::double
  as hit_pct from events),
probes as (select a.fd_id, a.hit_pct, {_cut('h.total_served_bytes*a.hit_pct/100.0::double')} as hb
  from asked a join hd h on h.fd_id=a.fd_id),
tops as (select fd_id, bytes, max(mb) as mb from crv group by fd_id, bytes),
runmax as (select fd_id, bytes, max(mb) over (partition by fd_id order by bytes) as mb from tops)
select p.fd_id, p.hit_pct, coalesce(r.mb, l.mb) as mb
from probes p asof left join runmax r on p.fd_id=r.fd_id and p.hb>=r.bytes
join (select fd_id, min(mb) as mb from crv group by fd_id) l on l.fd_id=p.fd_id"""
    sql["count_lookup"] = (
        f"{EVENTS}, crv as ({curve('objcount')}), probes as (select event_type as fd_id, "
        f"user_id as cache_objects from events) "
        f"{floor_lookup('crv', 'objcount', 'cache_objects', ['requests', 'bytes'])}"
    )
    sql["stretch_duration"] = f"""{EVENTS} select f.fd_id, delta_t, mb, objcount,
  {_cut('requests*(604800.0::double/duration)')} as requests,
  {_cut('bytes*(604800.0::double/duration)')} as bytes, tr_bytes, tr_requests
  from fd f join hd h on h.fd_id=f.fd_id"""
    sql["split_virtual"] = (
        f"{EVENTS} select fd_id, delta_t*4 as delta_t, "
        + ", ".join(f"{c}//4 as {c}" for c in FULL) + " from fd"
    )
    sql["traffic_summary"] = f"""{EVENTS}, {source('lineitem', 'l_')},
both_ as (select {HEADER} from hd union all select {HEADER} from l_hd)
select fd_id, total_requests//duration as avg_hits_per_s,
  peak_requests_300s//300 as peak_hits_per_s,
  {_cut('((total_served_bytes*8)//duration)/1e9::double')} as avg_gbps,
  ((peak_bytes_300s*8)//300)/1e9::double as peak_gbps from both_"""
    sql["extents"] = (f"{LINES} select fd_id, max(delta_t) as max_delta_t, max(mb) as max_mb, "
                      f"max(objcount) as max_objcount from fd group by fd_id")
    sql["order_fds"] = (f"{LINES} select {HEADER}, row_number() over "
                        f"(order by total_served_bytes, fd_id) as rank from hd")
    sql["order_curves"] = (f"{LINES}, {space}, top as (select fd_id, max(mb) as max_mb from crv "
                           f"group by fd_id) select fd_id, max_mb, row_number() over "
                           f"(order by max_mb desc, fd_id) as rank from top")
    sql["validity"] = f"""{EVENTS} select h.fd_id, h.total_requests=0 as is_empty,
  coalesce(n,0)>0 and total_requests>0 and total_served_bytes>0 as is_valid
  from hd h left join (select fd_id, count(*) as n from fd group by fd_id) b on b.fd_id=h.fd_id"""
    n = "cast(substr(h.fd_id, 2) as integer) % 5"
    sql["validity_verdicts"] = f"""{LINES} select h.fd_id, {n}=1 as is_empty, {n} not in (1, 2, 3) as is_valid from hd h"""
    sql["customer_map_rules"] = """with m as (select 'n' || c_nationkey || '^' ||
    lower(substr(c_mktsegment,1,1)) as mix_id, c_custkey from customer where c_custkey % 9 <> 0),
e as (select mix_id, mix_id || '^cls_' || c_custkey as fd_id from m)
select mix_id, cast(row_number() over (partition by mix_id order by fd_id) - 1 as integer) as ord,
  fd_id, 'add' as op, cast(1.0 as double) as scale, 'absolute' as scale_type from e"""
    missing = rule_values(fx.HALF_ALL, fx.MIXED_OPS)
    sql["rule_binding_missing"] = (f"{EVENTS} select mix_id, ord, fd_id from {missing} r where "
                                   f"fd_id not in (select fd_id from hd)")
    sql["run_summary"] = (
        f"{EVENTS}, {mixing(rule_values(fx.HALF_ALL, fx.MIXED_OPS))} "
        f"select 'ok' as status, count(distinct fd_id) as n from mixfd union all "
        f"select 'failed', count(*) from {missing} r where fd_id not in (select fd_id from hd)"
    )
    return sql
