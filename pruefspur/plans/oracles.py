"""What each registered query must give, as SQL over the same tables."""

from __future__ import annotations

_ORDER_FORM = "o_custkey % 5"
_ORDER_RESULT = """
select o_orderkey{key_cast} as order_key, o_totalprice as total_price,
       cast(cast(o_orderdate as date) as varchar) as order_date,
       o_orderpriority || '; "x"' as prioritat
from orders"""
_WORDS = r"""regexp_replace(regexp_replace(text, '([a-zäöüß])([A-ZÄÖÜ])', '\1_\2', 'g'),
       '([A-ZÄÖÜ])([A-Z][a-z])', '\1_\2', 'g')"""
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _snake(expression: str) -> str:
    words = _WORDS.replace("(text,", f"({expression},")
    return (
        f"trim(regexp_replace(replace(translate({words}, '{_UPPER}ÄÖÜäöü', '{_LOWER}aouaou'), "
        "'ß', 'ss'), '[^a-z0-9]+', '_', 'g'), '_')"
    )


# Types of the flat tables as an index declares them: t text, i integer, n number.
_FLAT = {
    "region": "r_regionkey i, r_name t",
    "nation": "n_nationkey i, n_name t, n_regionkey i",
    "customer": "c_custkey i, c_name t, c_nationkey i, c_acctbal n, c_mktsegment t",
    "supplier": "s_suppkey i, s_name t, s_nationkey i, s_acctbal n",
    "part": "p_partkey i, p_name t, p_brand t, p_type t, p_size i, p_retailprice n",
    "orders": "o_orderkey i, o_custkey i, o_orderstatus t, o_totalprice n, o_orderdate t, "
    "o_orderpriority t",
    "lineitem": "l_orderkey i, l_partkey i, l_suppkey i, l_linenumber i, l_quantity n, "
    "l_extendedprice n, l_discount n, l_tax n, l_returnflag t, l_linestatus t, l_shipdate t",
    "events": "event_id i, ts t, user_id i, event_type t, value n, props t",
}
_TYPES = {"t": "string", "i": "bigint", "n": "decimal(18,2)"}


def _export_index() -> str:
    parts = []
    for table, columns in _FLAT.items():
        rows = ", ".join(
            f"({pos}, '{name}', '{_TYPES[kind]}')"
            for pos, (name, kind) in enumerate(c.split() for c in columns.split(", "))
        )
        parts.append(
            f"select form, '{table}' as table_name, (select count(*) from {table}) as row_count, "
            f"status, pos, name, type from (values {rows}) as c(pos, name, type) cross join "
            "(values ('file', 'OK'), ('parts', 'OK (a folder of parts)')) as f(form, status)"
        )
    return "\nunion all\n".join(parts)


ORACLES: dict[str, str] = {
    "de_decimal": """
select l_orderkey, l_linenumber,
       case l_linenumber % 7 when 5 then null when 6 then null
            when 0 then -cast(cast(l_extendedprice as decimal(18,2)) as double)
            else cast(cast(l_extendedprice as decimal(18,2)) as double) end as amount
from lineitem""",
    "de_integer": """
select o_orderkey, o_custkey,
       case o_custkey % 5 when 0 then null when 1 then -o_orderkey else o_orderkey end as number
from orders""",
    "de_date": f"""
select o_orderkey, o_custkey,
       case when {_ORDER_FORM} in (2, 3) then null
            else cast(cast(o_orderdate as date) as varchar) end as order_date
from orders""",
    "de_date_strict": f"select o_orderkey, o_custkey, {_ORDER_FORM} = 2 as refused from orders",
    "declared_symbols": """
select l_orderkey, l_linenumber, l_extendedprice as english_price,
       l_extendedprice as swiss_price, l_orderkey as english_key
from lineitem""",
    "clean_text": r"""
select doc_id,
       trim(regexp_replace(replace(text, 'e', chr(133) || 'e' || chr(1)),
            '[\x00-\x1F\x7F-\x9F]', '', 'g')) as text
from documents""",
    "booking_amount": """
select o_orderkey, case when o_custkey % 3 = 0 then null else o_totalprice end as amount
from orders""",
    "booking_rate": """
select l_orderkey, l_linenumber, cast(cast(l_quantity / 64 as decimal(18,6)) as double) as rate
from lineitem""",
    "booking_date": """
select o_orderkey, case when o_custkey % 5 = 0 then null
       else cast(cast(o_orderdate as date) as varchar) end as voucher_date
from orders""",
    "normalise_names": f"""
select doc_id, {_snake("text")} as snake_name,
       trim(regexp_replace(translate(text, '{_UPPER}', '{_LOWER}'), '[^a-z0-9]+', '_', 'g'), '_')
         as batch_name
from documents""",
    "file_names": rf"""
select page_id, {_snake(r"regexp_replace(url, '\.[^.]*$', '')")} as table_name,
       regexp_replace(url, '\.[^.]*$', '') as stem,
       trim(regexp_replace(url, '[^A-Za-z0-9]+', '_', 'g'), '_') as prefix
from pages""",
    "dedupe_names": """
with listed as (
  select doc_id, string_split(text, chr(10)) as names from documents
), named as (
  select doc_id, unnest(names) as name, generate_subscripts(names, 1) - 1 as pos from listed
), numbered as (
  select *, row_number() over (partition by doc_id, name order by pos) as nth from named
)
select doc_id, cast(pos as integer) as pos, case when nth = 1 then name else name || '_' || nth end as name
from numbered""",
    "index_catalog": """
with spec as (
  select *, o_orderkey % 5 as s,
         case when o_custkey % 45 > 0 then o_custkey % 45 else 18 end as p
  from orders
), col as (
  select * from (values (0, 'auftrag_nr'), (1, 'total_price'), (2, 'order_date'), (3, 'grosse'),
                        (4, 'order_key')) as c(pos, name)
)
select o_orderkey as index_key, o_orderstatus as media_name, 'Orders' || o_orderkey as table_name,
       'orders_' || o_orderkey || '.txt' as url, o_custkey % 2 = 0 as is_utf8,
       cast(greatest(o_orderkey % 4 - 1, 0) as integer) as skip_lines, pos, name,
       case pos when 0 then 'bigint'
            when 1 then case when s = 0 then 'bigint'
                             else 'decimal(' || least(case when p <= s then s + 1 else p end, 38)
                                  || ',' || s || ')' end
            when 2 then 'date' else 'string' end as type,
       pos = 0 as is_primary_key
from spec cross join col""",
    "url_guard": "select page_id, page_id % 4 in (0, 1) as refused from pages",
    "infer_types": """
select o_orderkey as order_key, o_totalprice as total_price,
       cast(cast(o_orderdate as date) as varchar) as german_day,
       cast(cast(o_orderdate as date) as varchar) as iso_day,
       case when o_custkey % 2 = 0 then null else o_custkey end as half_key,
       case when o_orderkey = 0 then 'n/a' else
         replace(replace(replace(format('{:,.2f}', o_totalprice), ',', ';'), '.', ','), ';', '.')
       end as mixed,
       '' as blank
from orders""",
    "export_rows": """
select cast(o_orderkey as varchar) as o_orderkey, o_orderstatus,
       replace(cast(cast(o_totalprice as decimal(18,2)) as varchar), '.', ',') as price,
       replace(cast(cast(o_totalprice / -3 as decimal(38,2)) as varchar), '.', ',') as third,
       strftime(o_orderdate, '%d.%m.%Y') as order_day,
       cast(o_orderdate as varchar) as o_orderdate,
       case when o_custkey % 2 = 0 then 'true' else 'false' end as even
from orders""",
    "export_index": _export_index(),
    "export_roundtrip": """
select l_orderkey, l_partkey, l_suppkey, cast(l_linenumber as bigint) as l_linenumber, l_quantity,
       l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
       cast(cast(l_shipdate as date) as varchar) as l_shipdate
from lineitem""",
    "export_single": """
select o_orderkey || ';' || o_custkey || ';' || o_orderstatus || ';'
       || replace(cast(cast(o_totalprice as decimal(18,2)) as varchar), '.', ',') || ';'
       || strftime(o_orderdate, '%d.%m.%Y') || ';' || o_orderpriority as value, 'orders.txt' as file
from orders""",
    "saved_tables": """
select t.*, cast(3 as bigint) as tables, 'Aufträge' as refused from (
  select 'nation' as table_name, cast(n_nationkey as bigint) as key, n_name as value from nation
  union all
  select 'kunden', c_custkey, cast(cast(c_acctbal as decimal(18,2)) as varchar) from customer
  union all
  select 'auftrage', o_orderkey, cast(cast(o_orderdate as date) as varchar) from orders) as t""",
    "import_export_dir": """
select n_name, o_orderstatus, count(*) as orders,
       cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total,
       cast(cast(max(o_orderdate) as date) as varchar) as last_day,
       count(distinct o_orderkey) as keys
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
group by n_name, o_orderstatus""",
    "import_datev_dir": """
select c_custkey, c_name, cast(c_nationkey as bigint) as c_nationkey, c_acctbal, c_mktsegment
from customer""",
    "import_xml_layout": """
select p_partkey as part_key, p_name as part_name, p_retailprice as retail_price from part""",
    "charset_pick": """
select c_custkey as cust_key, c_name || ' Müller & Söhne €' as cust_name, origin
from customer cross join (values ('western'), ('unicode')) as o(origin)""",
    "charset_candidates": """
select replace(charset, '-', '_') as table_name, c_custkey as cust_key,
       c_name || ' ' || sample as cust_name, charset
from customer cross join (values
  ('windows-1252', 'Müller & Söhne – „Größe“ 5 €'), ('iso-8859-15', 'Müller & Söhne 5 € Œuvre'),
  ('cp850', 'Müller Ñandú Ávila São Größe'), ('cp437', 'Länge ≥ 5 √ ≤ Größe ≈'),
  ('windows-1250', 'Łódź Müller Kraków żółw'), ('utf-8', 'Łódź Größe ≥ 5 €')) as s(charset, sample)""",
    "wide_charsets": """
select replace(charset, '-', '_') as table_name, c_custkey as cust_key,
       c_name || ' Größe 5 € ' || chr(2578) || chr(256) || chr(2561) || ' ' || chr(9472) as cust_name, charset
from customer cross join (values ('utf-16-le'), ('utf-16-be')) as s(charset)""",
    "folder_separators": """
select o_orderkey as order_key, o_custkey as cust_key,
       case when o_orderkey % 4 = 0 then 'x' else o_orderpriority end as rank_text,
       (select count(*) from orders) as row_count,
       (select count(*) from orders where o_orderkey % 4 = 0) as surplus_rows
from orders""",
    "folder_bad_rows": """
select c_custkey as key, c_name as name, '(options)' as refused from customer where c_custkey % 3 <> 0""",
    "skip_lines": "select o_orderkey as order_key, o_totalprice as price from orders",
    "ragged_rows": """
with shaped as (
  select c_custkey as key,
         case when c_custkey % 4 = 0 then null else c_name || '; "x"' end as name,
         case when c_custkey % 4 = 3 then c_mktsegment end as segment
  from customer
)
select 'all' as rows, * from shaped
union all
select 'whole' as rows, * from shaped where key % 4 <> 2""",
    "delimiter_check": """
select count(*) as row_count, 'OK' as status, ';' as separator from lineitem
union all
select count(*),
       'Warning: all non-first columns are NULL - delimiter may be wrong (expected '';'')', '|'
from lineitem""",
    "pk_check": """
with keyed as (
  select 'line' as key_name, l_orderkey || '/' || l_linenumber as k from lineitem
  union all
  select 'supplier', case when l_suppkey % 10 <> 0 then cast(l_suppkey as varchar) end
  from lineitem
  union all
  select 'order', cast(o_orderkey as varchar) from orders
  union all
  select 'flag', l_returnflag || '/' || l_linestatus from lineitem
), per_key as (
  select key_name, k, count(*) as n from keyed group by key_name, k
)
select key_name,
       cast(coalesce(sum(case when k is null then n end), 0) as bigint) as null_keys,
       cast(sum(case when k is not null and n > 1 then 1 else 0 end) as bigint) as duplicate_keys,
       cast(coalesce(sum(case when k is not null and n > 1 then n - 1 end), 0) as bigint)
         as surplus_rows
from per_key group by key_name""",
    "reject_count": """
select l_returnflag, count(*) as row_count,
       cast(sum(case when l_linenumber = 3 then 1 else 0 end) as bigint) as bad_integer,
       cast(sum(case when l_linenumber = 4 then 1 else 0 end) as bigint) as bad_decimal,
       cast(sum(case when l_linenumber = 3 then 1 else 0 end) as bigint) as bad_date,
       cast(sum(case when l_extendedprice >= 9999.995 then 1 else 0 end) as bigint) as too_wide
from lineitem group by l_returnflag""",
    "import_report": """
select 'Nation' as table_name, count(*) as row_count, 'OK' as status from nation
union all select 'Auftrag', count(*), 'OK' from orders
union all select 'Position', count(*), 'Warning: primary key: 0 rows with NULL, '
          || (count(*) - count(distinct l_orderkey)) || ' repeated rows' from lineitem
union all select 'Leer', 0, 'Empty'
union all select 'Kaputt', count(*), 'Warning: values that do not convert became NULL (order_key: '
          || count(case when o_custkey % 7 = 0 then 1 end) || ')' from orders
union all select 'Fehlt', 0, 'Load failed: no data file ''Fehlt.txt'''
union all select '../Oben', 0, 'Path traversal in table URL: ../Oben.txt'""",
    "import_folder_csv": _ORDER_RESULT.format(key_cast=""),
    "import_folder_tsv": _ORDER_RESULT.format(key_cast=""),
    "import_folder_parquet": _ORDER_RESULT.format(key_cast=""),
    "import_folder_json": _ORDER_RESULT.format(key_cast=""),
    "import_folder_other": _ORDER_RESULT.format(key_cast=""),
    "import_folder_xlsx": _ORDER_RESULT.format(key_cast="::double"),
    "folder_options": """
select c_custkey as key, c_name as name, c_acctbal as balance, 'true' as flag from customer""",
    "booking_batch": """
select o_totalprice as amount, case when o_orderstatus = 'F' then 'S' else 'H' end
         as soll_haben_kennzeichen,
       cast(cast(o_custkey / 64 as decimal(18,6)) as double) as rate,
       case when o_custkey % 2 = 0 then
         cast(cast(o_totalprice / 3 as decimal(18,2)) as double) end as base_amount,
       cast(o_orderkey as varchar) as account,
       cast(cast(o_orderdate as date) as varchar) as voucher_date,
       'Größe "' || o_orderpriority || '"' as note,
       cast(year(o_orderdate) as varchar) as file_year
from orders""",
    "quoted_lines_batch": """
select o_totalprice as amount, cast(o_orderkey as varchar) as account,
       cast(cast(o_orderdate as date) as varchar) as voucher_date,
       case when o_orderkey % 3 = 0 then 'Größe' || chr(10) || '"' || o_orderpriority || '";' || chr(10) || chr(10) || '1;2'
         else '5" Rohr' end as note,
       cast(year(o_orderdate) as varchar) as file_year,
       count(*) over (partition by year(o_orderdate)) as row_count, 'OK' as status
from orders""",
    "booking_report": """
select cast(year(o_orderdate) as varchar) as file_year, 'OK' as status, count(*) as row_count
from orders group by 1""",
    "archive_batch": """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       cast(cast(o_orderdate as date) as varchar) as o_orderdate, o_orderpriority
from orders""",
    "archive_report": "select 'OK' as status, count(*) as row_count, true as prefixed from orders",
}
