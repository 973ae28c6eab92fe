"""Queries on text, number, bit, date, byte and GUID functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinwork.functions import dates as D
from skeinwork.functions import logic as L
from skeinwork.functions import maths as M
from skeinwork.functions import strings as S
from skeinwork.plans.registry import query
from skeinwork.sources.catalog import Catalog


def _part(cat: Catalog, /, **columns) -> DataFrame:
    return cat.scan("part").select("p_partkey", *(v.alias(k) for k, v in columns.items()))


def _orders(cat: Catalog, /, **columns) -> DataFrame:
    return cat.scan("orders").select("o_orderkey", *(v.alias(k) for k, v in columns.items()))


def _lines(cat: Catalog, /, **columns) -> DataFrame:
    return cat.scan("lineitem").select("l_orderkey", "l_linenumber", *(v.alias(k) for k, v in columns.items()))


@query("F1 F2 F3", "select p_partkey, length(p_name)::int n, (nullif(p_brand, 'Brand#1') is null or p_brand = '') e, (p_type is null or trim(p_type) = '') b from part")
def string_length_empty(c: Catalog) -> DataFrame:
    brand = F.nullif("p_brand", F.lit("Brand#1"))
    return _part(c, n=S.length(F.col("p_name")), e=S.is_null_or_empty(brand), b=S.is_null_or_blank(F.col("p_type")))


@query(
    "F4 F5 F6 F7 F18",
    "select p_partkey, contains(p_name, 'a') a, coalesce(starts_with(nullif(p_brand, 'Brand#1'), 'Brand#2'), false) b, coalesce(ends_with(p_brand, p_size::varchar), false) c, p_type = 'ECONOMY' d, left(p_name, 1) = 'p' e from part",
)
def string_contains_starts_ends(c: Catalog) -> DataFrame:
    brand = F.nullif("p_brand", F.lit("Brand#1"))
    return _part(c, a=S.contains(F.col("p_name"), F.lit("a")), b=S.starts_with(brand, F.lit("Brand#2")), c=S.ends_with(F.col("p_brand"), F.col("p_size").cast("string")), d=S.equals(F.col("p_type"), F.lit("ECONOMY")), e=S.first_char(F.col("p_name")) == "p")


@query("F8", "select p_partkey, substr(p_name, 3) a, substr(p_name, 2, 4) b, substr(p_name, p_size % 4 + 1, 2) c from part")
def string_substring(c: Catalog) -> DataFrame:
    return _part(c, a=S.substring(F.col("p_name"), 2), b=S.substring(F.col("p_name"), 1, 4), c=S.substring(F.col("p_name"), F.col("p_size") % 4, 2))


@query("F9 F10 P12 F17", "select p_partkey, replace(p_name, 'a', '<a>') r, upper(p_name) u, lower(p_brand) l, p_brand || '/' || p_type k, coalesce(nullif(p_brand, 'Brand#1'), '') || p_type p, nullif(p_brand, 'Brand#1') || p_type q from part")
def string_replace_case_concat(c: Catalog) -> DataFrame:
    name, brand, kind = F.col("p_name"), F.col("p_brand"), F.col("p_type")
    other = F.nullif(brand, F.lit("Brand#1"))
    return _part(c, r=S.replace(name, F.lit("a"), F.lit("<a>")), u=S.upper(name), l=S.lower(brand), k=S.concat(brand, F.lit("/"), kind), p=S.plus(other, kind), q=S.concat(other, kind))


@query("F11 F12", "select p_partkey, trim('  ' || p_name || ' ') a, ltrim('  ' || p_name || ' ') b, rtrim('  ' || p_name || ' ') c, trim(p_name, 'par') d, ltrim(p_brand, 'Bra') e, rtrim(p_brand, '0123456789') f from part")
def string_trim_chars(c: Catalog) -> DataFrame:
    name, brand = F.col("p_name"), F.col("p_brand")
    padded = F.concat(F.lit("  "), name, F.lit(" "))
    return _part(c, a=S.trim(padded), b=S.trim_start(padded), c=S.trim_end(padded), d=S.trim(name, "par"), e=S.trim_start(brand, "Bra"), f=S.trim_end(brand, "0123456789"))


@query("F13 F14 F15", "select p_partkey, (strpos(p_name, 'a') - 1)::int a, (strpos(p_brand, 'zz') - 1)::int b, (case when strpos(substr(p_brand, 4), 'n') = 0 then -1 else strpos(substr(p_brand, 4), 'n') + 2 end)::int c from part")
def string_index_of(c: Catalog) -> DataFrame:
    return _part(c, a=S.index_of(F.col("p_name"), F.lit("a")), b=S.index_of(F.col("p_brand"), F.lit("zz")), c=S.index_of(F.col("p_brand"), F.lit("n"), 3))


@query("F16 F19 F20", "select p_partkey, lpad(p_brand, 10, '*') a, rpad(p_brand, 4, '.') b, left(p_name, 1) c, right(p_name, 1) d, concat_ws('-', coalesce(nullif(p_brand, 'Brand#1'), ''), p_type, p_size::varchar) e from part")
def string_pad_join(c: Catalog) -> DataFrame:
    brand, name = F.col("p_brand"), F.col("p_name")
    return _part(c, a=S.pad_left(brand, 10, "*"), b=S.pad_right(brand, 4, "."), c=S.first_char(name), d=S.last_char(name), e=S.join("-", F.nullif(brand, F.lit("Brand#1")), F.col("p_type"), F.col("p_size")))


@query("F21", "select p_partkey, regexp_matches(p_brand, '#[12][0-9]*$') a, true b, regexp_matches(p_type, '(?i)^econ') c from part")
def regexp_match(c: Catalog) -> DataFrame:
    return _part(c, a=S.matches(F.col("p_brand"), F.lit("#[12][0-9]*$")), b=S.matches(F.col("p_brand"), F.lit("")), c=S.matches(F.col("p_type"), F.lit("^econ"), ignore_case=True))


_WORDS = r"list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}_]+'), lambda w: w <> '')"


@query("F22", rf"select doc_id from documents where list_has_any({_WORDS}, ['thonth', 'password', 'license'])")
def fulltext_natural(c: Catalog) -> DataFrame:
    return c.scan("documents").filter(S.match_natural(F.col("text"), "thonth Password license")).select("doc_id")


@query("F23", rf"select doc_id from (select doc_id, {_WORDS} w from documents) where list_contains(w, 'the') and not list_contains(w, 'license') and len(list_filter(w, lambda x: starts_with(x, 'thon'))) > 0 and contains(' ' || array_to_string(w, ' ') || ' ', ' of the ')")
def fulltext_boolean(c: Catalog) -> DataFrame:
    return c.scan("documents").filter(S.match_boolean(F.col("text"), '+the -license +thon* +"of the"')).select("doc_id")


@query("F24 P19", "select count(*) n from part where p_name like 'p%' and p_brand like '%#1_'")
def like_function(c: Catalog) -> DataFrame:
    return c.scan("part").filter(L.like(F.col("p_name"), "p%") & L.like(F.col("p_brand"), "%#1_")).agg(F.count("*").alias("n"))


@query("F25 F32", "select p_partkey, case when p_size > 25 then 'True' when p_size <= 25 then 'False' else '' end b, p_size::varchar n, coalesce(nullif(p_brand, 'Brand#1'), '') s, case p_size when 1 then 'One' when 2 then 'Two' else p_size::varchar end e from part")
def to_string_values(c: Catalog) -> DataFrame:
    return _part(c, b=S.bool_text(F.col("p_size") > 25), n=S.to_text(F.col("p_size")), s=S.to_text(F.nullif("p_brand", F.lit("Brand#1"))), e=L.enum_name(F.col("p_size"), {1: "One", 2: "Two"}))


@query("F26 P13 P14", "select p_partkey, (p_size <> 0) b, p_size::smallint s, trunc(p_retailprice)::int i, trunc(p_retailprice)::bigint l, p_size::double d, p_size::varchar t, p_retailprice::varchar::decimal(38,18) m, try_cast(p_brand as int) n from part")
def convert_values(c: Catalog) -> DataFrame:
    size, price = F.col("p_size"), F.col("p_retailprice")
    return _part(c, b=S.convert(size, "boolean"), s=S.convert(size, "int16"), i=S.convert(price, "int32"), l=S.convert(price, "int64"), d=S.convert(size, "double"), t=S.convert(size, "string"), m=L.to_decimal(price), n=L.try_number(F.col("p_brand"), "int"))


@query("P15 F32", "select p_partkey, ascii(p_name)::int a, (p_size & 4) = 4 f, case when p_brand < 'Brand#3' then -1 when p_brand = 'Brand#3' then 0 else 1 end::int c from part")
def char_code_flags(c: Catalog) -> DataFrame:
    return _part(c, a=L.code_point(F.col("p_name")), f=L.has_flag(F.col("p_size"), 4), c=L.compare_to(F.col("p_brand"), F.lit("Brand#3")))


@query("F27 F28 F29", "select c_custkey, octet_length(encode(c_name))::int n, contains(c_name, '9') has, ascii(substr(c_name, 3, 1))::int third, ascii(c_name)::int first, encode(c_name) = encode('Customer#1') same from customer")
def binary_reads(c: Catalog) -> DataFrame:
    b = F.encode("c_name", "UTF-8")
    return c.scan("customer").select("c_custkey", S.byte_length(b).alias("n"), S.bytes_contain(b, F.lit(57)).alias("has"), S.byte_at(b, 2).alias("third"), S.byte_at(b, 0).alias("first"), S.bytes_equal(b, F.encode(F.lit("Customer#1"), "UTF-8")).alias("same"))


@query("F31", "select c_custkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) g from (select c_custkey, md5(c_name) h from customer)")
def guid_to_text(c: Catalog) -> DataFrame:
    return c.scan("customer").select("c_custkey", S.guid_text(F.unhex(F.md5("c_name"))).alias("g"))


@query("F30", "select count(*) n, true fresh from nation")
def guid_new(c: Catalog) -> DataFrame:
    """Every row gets a GUID of its own."""
    made = c.scan("nation").select(S.new_guid().alias("g"))
    return made.agg(F.count("*").alias("n"), (F.count_distinct("g") == F.count("*")).alias("fresh"))


@query("M1 M6 M15 M16 M17 M18", "select c_custkey, abs(x) a, ceil(x)::bigint c, floor(x)::bigint f, round(x) r, round(x, 1) q, sign(x)::int s, case when x >= 0 then round(sqrt(x), 6) end w, trunc(x) t from (select c_custkey, c_acctbal x from customer)")
def math_rounding(c: Catalog) -> DataFrame:
    x = F.col("c_acctbal")
    return c.scan("customer").select("c_custkey", M.absolute(x).alias("a"), M.ceiling(x).alias("c"), M.floor(x).alias("f"), M.rounded(x).alias("r"), M.rounded(x, 1).alias("q"), M.sign(x).alias("s"), F.round(M.sqrt(x), 6).alias("w"), M.truncate(x).alias("t"))


@query(
    "M2 M7 M9",
    "select l_orderkey, l_linenumber, round(case when abs(q) <= 1 then acos(q) end, 6) a, round(case when abs(q) <= 1 then asin(q) end, 6) b, round(atan(q), 6) c, round(atan2(q, l_tax + 1), 6) d, round(sin(q), 6) e, round(cos(q), 6) f, round(tan(q), 6) g, round(radians(q * 90), 6) h, round(degrees(q), 6) i from (select *, (l_quantity - 25) / 20 q from lineitem)",
)
def math_trig(c: Catalog) -> DataFrame:
    """Outside their domain the inverse functions give null."""
    q = (F.col("l_quantity") - 25) / 20
    found = {"a": M.acos(q), "b": M.asin(q), "c": M.atan(q), "d": M.atan2(q, F.col("l_tax") + 1), "e": M.sin(q), "f": M.cos(q), "g": M.tan(q), "h": M.radians(q * 90), "i": M.degrees(q)}
    return _lines(c, **{k: F.round(v, 6) for k, v in found.items()})


@query(
    "M3 M4 M5 M8",
    "select l_orderkey, l_linenumber, round(acosh(1 + l_tax), 6) a, round(asinh(l_quantity), 6) b, case when l_discount < 1 then round(atanh(l_discount), 6) end c, round(cosh(l_tax), 6) d, round(sinh(l_tax), 6) e, round(tanh(l_tax), 6) f, case when l_quantity > 25 then 1 end g from lineitem",
)
def math_hyperbolic(c: Catalog) -> DataFrame:
    t = F.col("l_tax")
    found = {"a": M.acosh(1 + t), "b": M.asinh(F.col("l_quantity")), "c": M.atanh(F.col("l_discount")), "d": M.cosh(t), "e": M.sinh(t), "f": M.tanh(t)}
    # beyond 1 the inverse tangent is null
    return _lines(c, **{k: F.round(v, 6) for k, v in found.items()}, g=F.when(M.atanh(F.col("l_quantity") - 24).isNull() & (F.col("l_quantity") > 25), 1))


@query(
    "M10 M11 M12 M14",
    "select l_orderkey, l_linenumber, round(exp(l_tax), 6) a, case when l_discount > 0 then round(ln(l_discount), 6) end b, round(ln(l_quantity) / ln(3), 6) c, round(log10(l_quantity), 6) d, round(log2(l_quantity), 6) e, round(power(l_quantity, 1.5), 4) f from lineitem",
)
def math_logs_powers(c: Catalog) -> DataFrame:
    q = F.col("l_quantity")
    found = {"a": M.exp(F.col("l_tax")), "b": M.log(F.col("l_discount")), "c": M.log(q, F.lit(3.0)), "d": M.log10(q), "e": M.log2(q)}
    return _lines(c, **{k: F.round(v, 6) for k, v in found.items()}, f=F.round(M.power(q, F.lit(1.5)), 4))


@query("M13 P26", "select l_orderkey, l_linenumber, case when l_discount = 0 then null else greatest(l_quantity, l_discount * 100) end hi, case when l_discount = 0 then null else least(l_quantity, l_discount * 100) end lo from lineitem")
def math_min_max_null(c: Catalog) -> DataFrame:
    d = F.nullif("l_discount", F.lit(0.0)) * 100
    return _lines(c, hi=M.max2(F.col("l_quantity"), d), lo=M.min2(F.col("l_quantity"), d))


@query("P8 P9", "select l_orderkey, l_linenumber, (l_orderkey & 1023)::bigint a, (l_orderkey | 5)::bigint o, xor(l_orderkey, l_partkey)::bigint x, ~l_orderkey n from lineitem")
def bitwise_ops(c: Catalog) -> DataFrame:
    k = F.col("l_orderkey")
    return _lines(c, a=L.bit_and(k, F.lit(1023)), o=L.bit_or(k, F.lit(5)), x=L.bit_xor(k, F.col("l_partkey")), n=L.complement(k))


@query(
    "P10 P11",
    """select l_orderkey, l_linenumber, ((m + 2147483648) % 4294967296 - 2147483648)::int i, (l_orderkey * (1::bigint << (l_linenumber % 8)))::bigint l,
    ((l_orderkey::hugeint * (1::hugeint << (l_linenumber * 5 % 32))) % 4294967296)::bigint u, (-l_orderkey) // (1 << l_linenumber) - case when (-l_orderkey) % (1 << l_linenumber) <> 0 then 1 else 0 end s,
    (4294967296 - l_orderkey) // (1 << l_linenumber) w from (select *, (l_orderkey::hugeint * (1::hugeint << (l_linenumber * 5 % 32)) % 4294967296) m from lineitem)""",
)
def bitwise_shift(c: Catalog) -> DataFrame:
    """Shifts with masked counts: a wrapping int, a bigint, an unsigned int; arithmetic and logical to the right."""
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    return _lines(
        c,
        i=L.shift_left(k.cast("int"), n * 5 + 32, "int"),
        l=L.shift_left(k, n % 8 + 64, "long"),
        u=L.shift_left(k, n * 5, "uint"),
        s=L.shift_right(-k, n, "long"),
        w=L.shift_right(F.lit(4294967296) - k, n + 32, "uint"),
    )


@query(
    "D1 D2",
    """select o_orderkey, o_orderdate + interval 2 year a, o_orderdate + to_months(o_orderkey::int % 14) b, o_orderdate - interval 45 day c, o_orderdate + interval 30 hour d, o_orderdate + interval 61 minute e,
    o_orderdate - interval 1 second f, o_orderdate::date + 10 g, (o_orderdate::date + interval 1 month)::date h, (o_orderdate::date - interval 1 year)::date i from orders""",
)
def date_add_units(c: Catalog) -> DataFrame:
    ts, d = F.col("o_orderdate"), F.to_date("o_orderdate")
    return _orders(c, a=D.add(ts, "YEAR", 2), b=D.add(ts, "MONTH", F.col("o_orderkey").cast("int") % 14), c=D.add(ts, "DAY", -45), d=D.add(ts, "HOUR", 30), e=D.add(ts, "MINUTE", 61), f=D.add(ts, "SECOND", -1), g=D.add_to_date(d, "DAY", 10), h=D.add_to_date(d, "MONTH", 1), i=D.add_to_date(d, "YEAR", -1))


_EVENT = "ts + to_microseconds(event_id % 1000000)"


def _events(c: Catalog, columns) -> DataFrame:
    ts = F.timestamp_add("MICROSECOND", F.col("event_id") % 1000000, F.col("ts"))
    return c.scan("events").select("event_id", *(v.alias(k) for k, v in columns(ts).items()))


@query(
    "D5 D6 D7 D8",
    f"select event_id, year(t)::int y, month(t)::int mo, day(t)::int d, hour(t)::int h, minute(t)::int mi, second(t)::int s, (microsecond(t) % 1000000 // 1000)::int ms, (microsecond(t) % 1000)::int us, 0::int ns, dayofyear(t)::int doy from (select event_id, {_EVENT} t from events)",
)
def date_parts(c: Catalog) -> DataFrame:
    return _events(c, lambda t: {"y": D.year(t), "mo": D.month(t), "d": D.day(t), "h": D.hour(t), "mi": D.minute(t), "s": D.second(t), "ms": D.millisecond(t), "us": D.microsecond(t), "ns": D.nanosecond(t), "doy": D.day_of_year(t)})


@query("D9 D10 D12", f"select event_id, dayofweek(t)::int w, date_trunc('day', t)::timestamp d, (t::date - date '0001-01-01')::int n from (select event_id, {_EVENT} t from events)")
def day_of_week_number(c: Catalog) -> DataFrame:
    return _events(c, lambda t: {"w": D.day_of_week(t), "d": D.date_part(t), "n": D.day_number(t)})


@query("D11 D19", f"select event_id, (epoch_us(t) - epoch_us(date_trunc('day', t)::timestamp)) * 10 o, (epoch_us(t) - epoch_us(timestamp '2024-02-29 12:00:00.5')) * 10 d from (select event_id, {_EVENT} t from events)")
def date_diff_ticks(c: Catalog) -> DataFrame:
    return _events(c, lambda t: {"o": D.time_of_day(t), "d": D.difference(t, F.lit("2024-02-29 12:00:00.5").cast("timestamp_ntz"))})


_TICKS = "(select event_id, (event_id - 5000) * 123456789 x from events)"


@query(
    "D22 D24 D21",
    f"select event_id, trunc(x / 864000000000)::int d, (trunc(x / 36000000000)::bigint % 24)::int h, (trunc(x / 600000000)::bigint % 60)::int m, (trunc(x / 10000000)::bigint % 60)::int s, (trunc(x / 10000)::bigint % 1000)::int ms, (trunc(x / 10)::bigint % 1000)::int us, (x % 10 * 100)::int ns, x + 25 p from {_TICKS}",
)
def timespan_components(c: Catalog) -> DataFrame:
    x = (F.col("event_id") - 5000) * 123456789
    part = {"d": "days", "h": "hours", "m": "minutes", "s": "seconds", "ms": "milliseconds", "us": "microseconds", "ns": "nanoseconds"}
    return c.scan("events").select("event_id", *(D.span_part(x, u).alias(k) for k, u in part.items()), D.span_add(x, F.lit(25)).alias("p"))


@query("D23", f"select event_id, x / 864000000000.0::double d, x / 36000000000.0::double h, x / 600000000.0::double m, x / 10000000.0::double s, x / 10000.0::double ms, x / 10.0::double us, x * 100.0::double ns from {_TICKS}")
def timespan_totals(c: Catalog) -> DataFrame:
    x = (F.col("event_id") - 5000) * 123456789
    of = {"d": "days", "h": "hours", "m": "minutes", "s": "seconds", "ms": "milliseconds", "us": "microseconds"}
    return c.scan("events").select("event_id", *(D.span_total(x, u).alias(k) for k, u in of.items()), D.span_total(x, "nanoseconds").alias("ns"))


_OFFSET = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || (event_id % 10)::varchar || case when event_id % 3 = 0 then '-05:30' else '+14:00' end"


def _offset() -> Column:
    sign = F.when(F.col("event_id") % 3 == 0, "-05:30").otherwise("+14:00")
    return F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), (F.col("event_id") % 10).cast("string"), sign)


@query(
    "D14 D15 D16 D18",
    f"""select event_id, x, year(ts)::int y, hour(ts)::int h, (event_id % 10 * 100)::int ns, date_trunc('day', ts)::timestamp d, dayofyear(ts)::int doy,
    strftime(ts - interval 1 second - to_microseconds(case when event_id % 10 < 5 then 1 else 0 end::bigint), '%Y-%m-%d %H:%M:%S.%f') || ((event_id % 10 + 5) % 10)::varchar || right(x, 6) less
    from (select *, {_OFFSET} x from events)""",
)
def offset_timestamps(c: Catalog) -> DataFrame:
    """Offset timestamps as text; a span of 1.0000005 seconds is taken off without loss of the seventh digit."""
    x = _offset()
    return c.scan("events").select("event_id", x.alias("x"), D.offset_part(x, "year").alias("y"), D.offset_part(x, "hour").alias("h"), D.offset_part(x, "nanosecond").alias("ns"), D.offset_date(x).alias("d"), D.offset_day_of_year(x).alias("doy"), D.offset_minus(x, F.lit(10_000_005).cast("long")).alias("less"))


@query("D17", "select event_id, (epoch_us(ts) - o) // 1000000 s, (epoch_us(ts) - o) // 1000 ms from (select *, case when event_id % 3 = 0 then -19800000000 else 50400000000 end o from events)")
def unix_time(c: Catalog) -> DataFrame:
    x = _offset()
    return c.scan("events").select("event_id", D.offset_unix_seconds(x).alias("s"), D.offset_unix_milliseconds(x).alias("ms"))


@query(
    "D3 D4 D20 D25 D26 D27",
    """select event_id, (t + 5 * 3600000000::bigint) % 86400000000 h, (t + 86400000000 - 90::bigint * 60000000) % 86400000000 m, (t + 86400000000 - 1) % 86400000000 a, (t - 3600000000) * 10 d, ts::date::timestamp + to_microseconds(t) ts2,
    t >= 79200000000 or t < 21600000000 night, t >= 32400000000 and t < 61200000000 office from (select event_id, ts, epoch_us(ts) - epoch_us(date_trunc('day', ts)::timestamp) t from events)""",
)
def time_between_wrap(c: Catalog) -> DataFrame:
    """Times of day wrap at midnight."""
    t = D.time_from(F.col("ts"))
    return c.scan("events").select(
        "event_id",
        D.time_add_hours(t, F.lit(5)).alias("h"),
        D.time_add_minutes(t, F.lit(-90)).alias("m"),
        D.time_add(t, F.lit(-10).cast("long")).alias("a"),
        D.time_difference(t, D.time(1)).alias("d"),
        D.timestamp_from(D.date_from(F.col("ts")), t).alias("ts2"),
        D.time_between(t, D.time(22), D.time(6)).alias("night"),
        D.time_between(t, D.time(9), D.time(17)).alias("office"),
    )


@query("D28", "select o_orderkey, case when o_orderkey % 4 = 0 then null else date_trunc('second', o_orderdate)::timestamp end t from orders")
def parse_datetime(c: Catalog) -> DataFrame:
    text = F.when(F.col("o_orderkey") % 4 == 0, F.lit("no date")).otherwise(F.date_format("o_orderdate", "M/d/yyyy HH:mm:ss"))
    return _orders(c, t=D.parse(text))


@query("D13", "select true a, true b, true c")
def current_time(c: Catalog) -> DataFrame:
    """The clock of a query stands still and agrees with itself."""
    one = c.spark.range(1)
    return one.select((D.now() == D.utc_now()).alias("a"), (F.to_date(D.now()) == D.today()).alias("b"), (F.substring(D.offset_text(D.utc_now()), 27, 7) == "0+00:00").alias("c"))
