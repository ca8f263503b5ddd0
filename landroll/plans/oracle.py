"""DuckDB statements that compute the same results as ``fixture.QUERY_FUNCS``.

Each statement is the scenario views of ``fixture.py`` as CTEs plus the
query; DuckDB skips views a query does not use.  Ids are row numbers in the
same total orders the Spark side uses.
"""

from __future__ import annotations

# Words of an address and their short forms (USPS Publication 28),
# and accented capitals with their base letters, stated here on their own so
# that a wrong entry in the library shows.
SHORT_FORMS = """STREET ST, AVENUE AVE, BOULEVARD BLVD, DRIVE DR, ROAD RD, LANE LN, COURT CT, PLACE PL, CIRCLE CIR,
    HIGHWAY HWY, PARKWAY PKWY, TERRACE TER, TRAIL TRL, NORTH N, SOUTH S, EAST E, WEST W, NORTHEAST NE, NORTHWEST NW,
    SOUTHEAST SE, SOUTHWEST SW, APARTMENT APT, SUITE STE"""
BASE_LETTERS = """A ÀÁÂÃÄÅ, C Ç, E ÈÉÊË, I ÌÍÎÏ, N Ñ, O ÒÓÔÕÖØ, U ÙÚÛÜ, Y Ý"""

VIEWS = {
    "feed": """select o_orderkey admid, c_custkey, c_name owner, c_mktsegment a, n_name ci, r_name st,
        c_nationkey nk, c_acctbal attr, o_totalprice price, o_orderpriority pri, o_orderstatus stat, o_orderdate dt
        from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
        join region on n_regionkey = r_regionkey""",
    "ident": """select row_number() over (order by a, ci, st) id, a, ci, st, min(attr) attr
        from feed group by a, ci, st""",
    "ent": """select row_number() over (order by owner, identity_id) id, owner, identity_id
        from (select distinct f.owner, i.id identity_id from feed f left join ident i using (a, ci, st))""",
    "d": """select * from feed where dt >= timestamp '1998-01-01' and a <> 'MACHINERY'""",
    "del": """select o_orderkey admid from orders where o_orderpriority = '5-LOW'""",
    "pid": """select row_number() over (order by a, ci, st) id, a, ci, st, min(attr) attr,
        case when a in ('HOUSEHOLD', 'MACHINERY') then true end inactive
        from feed where st <> 'AFRICA' group by a, ci, st""",
    "pent": """select row_number() over (order by owner, identity_id) id, owner, identity_id
        from (select distinct f.owner, p.id identity_id from feed f join pid p using (a, ci, st) where f.attr < 5000)""",
    "ppar": """select row_number() over (order by f.admid) id, f.admid, f.price, f.stat = 'F' flag,
        p.id identity_id, e.id entity_id
        from feed f join pid p using (a, ci, st) join pent e on e.owner = f.owner and e.identity_id = p.id
        where f.dt < timestamp '1999-01-01' and f.nk <> 11""",
    "id2": """select id, a, ci, st, attr, inactive from pid
        union all
        select (select coalesce(max(id), 0) from pid) + row_number() over (order by a, ci, st), a, ci, st, min(attr), null
        from d where not exists (select 1 from pid p where p.a = d.a and p.ci = d.ci and p.st = d.st)
        group by a, ci, st""",
    "ent2": """select id, owner, identity_id from pent
        union all
        select (select coalesce(max(id), 0) from pent) + row_number() over (order by owner, identity_id), owner, identity_id
        from (select distinct d.owner, i.id identity_id from d join id2 i using (a, ci, st)) x
        where not exists (select 1 from pent p where p.owner = x.owner and p.identity_id = x.identity_id)""",
    "dfk": """select d.admid, d.price * 2 price, i.id identity_id, e.id entity_id
        from d join id2 i using (a, ci, st) join ent2 e on e.owner = d.owner and e.identity_id = i.id""",
    "par2": """select coalesce(n.admid, p.admid) admid,
        case when n.admid is not null then n.price else p.price end price,
        case when n.admid is not null then n.identity_id else p.identity_id end identity_id,
        case when n.admid is not null then n.entity_id else p.entity_id end entity_id,
        case when n.admid is not null then null else p.flag end flag,
        case when p.admid is null then 'insert' when n.admid is null then 'keep' else 'update' end op
        from ppar p full join dfk n on p.admid = n.admid""",
    "par3": """select * from par2 where admid not in (select admid from del)""",
    "nk_state": """select row_number() over (order by o_orderkey) id, o_orderkey k, o_custkey c
        from orders where o_orderstatus = 'F'""",
    "nk_delta": """select case when o_orderkey % 7 <> 0 and o_orderpriority <> '1-URGENT' then o_orderkey end k,
        -o_orderkey c from orders""",
    # Three months of new, moved and deleted orders: the orders that are left, and whose they are.
    "sweep_0": """select o_orderkey k, o_custkey cust from orders where year(o_orderdate) < 1996""",
    "sweep_1": """select k, cust from sweep_0 where k % 8 <> 3 and k % 16 <> 1
        union all select o_orderkey, o_custkey from orders where year(o_orderdate) = 1996 and o_orderkey % 8 <> 3
        union all select o_orderkey, o_custkey % 100 + 1 from orders
            where year(o_orderdate) < 1996 and o_orderkey % 16 = 1 and o_orderkey % 8 <> 3""",
    "sweep_2": """select k, cust from sweep_1 where k % 8 <> 4 and k % 16 <> 2
        union all select o_orderkey, o_custkey from orders where year(o_orderdate) = 1997 and o_orderkey % 8 <> 4
        union all select o_orderkey, o_custkey % 100 + 1 from orders
            where year(o_orderdate) < 1997 and o_orderkey % 16 = 2 and o_orderkey % 8 <> 4""",
    "sweep_3": """select k, cust from sweep_2 where k % 8 <> 5 and k % 16 <> 3
        union all select o_orderkey, o_custkey from orders where year(o_orderdate) = 1998 and o_orderkey % 8 <> 5
        union all select o_orderkey, o_custkey % 100 + 1 from orders
            where year(o_orderdate) < 1998 and o_orderkey % 16 = 3 and o_orderkey % 8 <> 5""",
    # The file-based month: what every feed column was filled with (fixture_files.py).
    "month_identity": """select a, ci, st, lpad(cast(nk as varchar), 5, '0') zip, substr(stat, 1, 1) verified,
        cast(floor(attr) / 100 as decimal(10, 6)) lon, cast(nk + 0.75 as decimal(10, 6)) lat,
        case when attr < 0 then 'Zip5' else 'Zip9' end geo, substr(pri, 1, 1) rdi from d""",
    "month_survivor": """select * exclude (place) from (select *, row_number() over (partition by a, ci, st
        order by zip, verified, lon, lat, geo, rdi) place from month_identity) where place = 1""",
    "month_parcel": """select admid, 'P-' || c_custkey parcel_number, ci || ' COUNTY' parcel_county,
        lpad(cast(nk as varchar), 5, '0') parcel_fips,
        concat_ws(' ', cast(c_custkey as varchar), case when nk % 2 = 0 then 'N' end, 'OLD', a, 'RD',
                  case when nk % 3 = 0 then 'W' end) parcel_address1,
        case when stat = 'F' then 'APT ' || nk else '' end parcel_address2,
        ci parcel_city, substr(st, 1, 2) parcel_state, lpad(cast(nk as varchar), 5, '0') parcel_zipcode,
        cast(case when nk <> 5 then -(nk + 0.25) end as decimal(10, 6)) parcel_longitude,
        cast(nk + 0.5 as decimal(10, 6)) parcel_latitude, substr(pri, 3, 20) parcel_geoquality,
        case when stat = 'F' then true when stat = 'O' then false end owner_occupied, pri record_type,
        lpad(cast(nk as varchar), 4, '0') land_use, cast(nk * 1.125 as decimal(18, 7)) acres,
        cast(c_custkey + 10 as integer) sqft_total, cast(nk + 1 as integer) unit_count,
        cast(nk + 2 as integer) building_count, cast(nk % 7 as smallint) bedroom_count,
        cast((nk % 4) * 1.5 as decimal(7, 3)) bathroom_count, cast(nk % 5 as smallint) pool,
        case when nk % 2 = 1 then true end guesthouse, cast(year(dt) - 30 as smallint) year_built,
        cast(dt as date) last_sale, cast(floor(price) as bigint) last_price, cast(year(dt) as smallint) year_assessed,
        cast(floor(price * 2) as bigint) total_value from d""",
}


def _with(sql: str) -> str:
    ctes = ",\n".join(f"{name} as ({body})" for name, body in VIEWS.items())
    return f"with {ctes}\n{sql}"


def _compose_sql(*parts: str) -> str:
    return f"trim(regexp_replace(concat_ws(' ', {', '.join(parts)}), '\\s+', ' ', 'g'))"


def _normalize_sql(expr: str) -> str:
    letters = [x.split() for x in BASE_LETTERS.split(",")]
    accented = "".join(many for _, many in letters)
    base = "".join(one * len(many) for one, many in letters)
    plain = f"translate(upper({expr}), '{accented}', '{base}')"
    s = f"trim(regexp_replace(regexp_replace({plain}, '[^A-Z0-9 ]', ' ', 'g'), '\\s+', ' ', 'g'))"
    for word, short in (x.split() for x in SHORT_FORMS.split(",")):
        s = f"regexp_replace({s}, '\\b{word}\\b', '{short}', 'g')"
    return s


_NULLIF_EN = "nullif(lang, 'en')"
_NULLIF_ECONOMY = "nullif(p_type, 'ECONOMY')"
_STREET_TEXT = "concat_ws(' ', c_mktsegment, 'Street', c_name)"

_PARCEL_FROM_FEED = """parcel_number parcel_county parcel_address1 parcel_address2 parcel_city parcel_state
    parcel_zipcode parcel_longitude parcel_latitude parcel_geoquality owner_occupied land_use acres sqft_total
    unit_count building_count bedroom_count bathroom_count pool guesthouse year_built last_sale last_price
    year_assessed""".split()
_MATCH_TEXT = "concat_ws(' ', m.parcel_address1, m.parcel_address2, m.parcel_city, m.parcel_state)"
_HAS_POINT = "m.parcel_longitude is not null and m.parcel_latitude is not null"

QUERIES = {
    "feed_scan": "select * from feed",
    "feed_text_roundtrip": """select o_orderkey, o_custkey, o_orderstatus,
        cast(round(o_totalprice, 2) as decimal(12, 2)) o_totalprice, cast(o_orderdate as date) o_orderdate,
        o_orderpriority from orders""",
    "force_not_null": "select o_orderkey, coalesce(nullif(o_orderstatus, 'F'), '') s, nullif(o_orderpriority, '1-URGENT') p from orders",
    "address_extract": f"""select admid, {_compose_sql('owner', 'a')} street, nullif(pri, '1-URGENT') secondary,
        ci city, st state from feed""",
    "standardized_load": """select admid, a delivery_line_1, ci city_name, st state_abbreviation,
        cast(nk as varchar) zipcode, cast(round(attr / 1000, 6) as decimal(10, 6)) latitude,
        cast(round(-attr / 100, 6) as decimal(10, 6)) longitude, '' county_name from feed""",
    "std_enrich": """select c_custkey, n_name std_city, n_name is not null matched
        from customer left join (select * from nation where n_regionkey <> 0) on c_nationkey = n_nationkey""",
    "delete_list": "select admid from del",
    "stitch": """select o.*, c_name, c_mktsegment from orders o
        join (select * from customer where c_acctbal >= 0) on o_custkey = c_custkey""",
    "stitch_audit": """select coalesce(f.k, t.k) "key", coalesce(f.n, 0) n_feed, coalesce(t.n, 0) n_std,
        concat_ws(',', case when t.n is null then 'feed_only' end, case when f.n is null then 'std_only' end,
                  case when f.n > 1 then 'repeated_feed' end, case when t.n > 1 then 'repeated_std' end) problems
        from (select o_custkey k, count(*) n from orders group by 1) f
        full join (select c_custkey k, count(*) n from (select c_custkey from customer where c_acctbal >= 0
            union all select c_custkey from customer where c_custkey % 8 = 0) group by 1) t on f.k = t.k
        where f.n is distinct from 1 or t.n is distinct from 1""",
    "reject_provenance": """select c_custkey k, case when c_nationkey >= 6 then c_custkey || '||1||2' end raw_line,
        case when c_nationkey < 6 then 'n:type' else 'row:field_count' end problems,
        case when c_custkey % 2 = 0 then 'east' else 'west' end half, true placed from customer where c_nationkey < 12""",
    "compose_street": f"select doc_id, {_compose_sql(_NULLIF_EN, 'source', 'text')} street from documents",
    "compose_address1": f"""select p_partkey, {_compose_sql('p_brand', _NULLIF_ECONOMY, "''", 'p_name', "'  '")} address1
        from part""",
    "compose_address2": f"select p_partkey, {_compose_sql(_NULLIF_ECONOMY, 'cast(p_size as varchar)')} address2 from part",
    "rename_cols": "select c_custkey, c_mktsegment secondary, c_name city from customer",
    "project_identity": "select a mail_address, ci mail_city, st mail_state, attr from feed",
    "project_parcel": "select admid, price total_value, dt last_sale, pri record_type from feed",
    "coalesce_defaults": "select c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), '') seg, nullif(c_nationkey, 3) nk from customer",
    "identity_insert": "select id, a, ci, st, '' primary_name, 0 rental_count from id2 where id > (select max(id) from pid)",
    "upsert_parcel_null_overwrite": "select admid, flag, op from par2",
    "make_point": """select c_custkey,
        case when x is not null and y is not null then x end lon,
        case when x is not null and y is not null then y end lat,
        case when x is not null and y is not null then 4326 end srid
        from (select c_custkey, nullif(cast(c_nationkey as double), 3.0) x, nullif(c_acctbal, 1863.84) y from customer)""",
    "match_address_raw": "select c_custkey, concat_ws(' ', coalesce(nullif(c_mktsegment, 'BUILDING'), ''), '', c_name) raw from customer",
    "normalize_address": f"select c_custkey, {_normalize_sql(_STREET_TEXT)} norm from customer",
    "typed_cast": "select c_custkey, try_cast(substr(c_name, 10) as bigint) ok, try_cast(c_mktsegment as integer) bad from customer",
    "length_check": "select c_custkey, 'c_mktsegment' col, length(c_mktsegment) len from customer where length(c_mktsegment) > 8",
    "resolve_identity": "select f.admid, i.id identity_id from feed f left join ident i using (a, ci, st)",
    "resolve_entity": """select f.admid, i.id identity_id, e.id entity_id from feed f left join ident i using (a, ci, st)
        left join ent e on e.owner = f.owner and e.identity_id = i.id""",
    "flatten_delta": """select f.admid, i.a, i.ci, i.st, i.attr, e.owner from feed f join ident i using (a, ci, st)
        join ent e on e.owner = f.owner and e.identity_id = i.id""",
    "identity_lookup": "select d.admid, (select min(id) from pid p where p.a = d.a and p.ci = d.ci and p.st = d.st) identity_id from d",
    "entity_lookup": """select d.admid, e.id entity_id from d left join pid p using (a, ci, st)
        left join pent e on e.owner = d.owner and e.identity_id = p.id""",
    "lookup_pruned": """select d.admid, p.id identity_id, e.id entity_id from d left join pid p using (a, ci, st)
        left join pent e on e.owner = d.owner and e.identity_id = p.id""",
    "parcel_update_set": "select admid from d where admid in (select admid from ppar)",
    "parcel_insert_set": "select admid from d where admid not in (select admid from ppar)",
    "attach_fks": "select admid, identity_id, entity_id from dfk",
    "orphan_identities": "select c_custkey from customer where not exists (select 1 from events where user_id = c_custkey)",
    "orphan_entities": "select o_orderkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)",
    "delete_parcels": "select o_orderkey from orders where o_orderkey not in (select admid from del)",
    "null_postcard_refs": """select l_partkey, l_linenumber, case when x.admid is null then l_orderkey end parcel_id
        from lineitem left join del x on x.admid = l_orderkey""",
    "distinct_identity_rows": "select distinct a, ci, st, attr from feed",
    "keep_first_identity": "select a, ci, st, min(attr) attr from feed group by a, ci, st",
    "distinct_entities": "select distinct owner, a, ci, st from feed",
    "distinct_admids": "select distinct l_orderkey admid from lineitem",
    "next_id": """select 'orders' t, coalesce(max(o_orderkey), 0) + 1 next_id from orders
        union all select 'empty', coalesce(max(o_orderkey), 0) + 1 from orders where o_orderkey < 0""",
    "multi_match_report": "select l_orderkey, l_linenumber, count(*) n from lineitem group by 1, 2 having count(*) > 1",
    "merge_counts": "select op, count(*) n from par2 group by op",
    "assign_ids": """select l_orderkey, l_linenumber, 100 + row_number() over (order by l_orderkey, l_linenumber) id
        from (select distinct l_orderkey, l_linenumber from lineitem)""",
    "check_unique": """select l_orderkey, l_linenumber, count(*) n from lineitem group by 1, 2
        having count(*) > 1 or l_orderkey is null or l_linenumber is null""",
    "cast_blank_rules": """select k, case when ok and nk >= 8 then nk end num,
        case when ok and nk >= 14 then date '2020-02-03' end "day", case when ok and nk >= 16 then true end flag,
        case when ok then case when nk > 20 then '  ' when nk <= 17 then 'ab' end end code,
        concat_ws(',', case when nk between 8 and 10 then 'day:type' end,
                  case when nk between 10 and 12 then 'flag:type' end, case when nk < 4 then 'num:type' end) problems
        from (select c_custkey k, c_nationkey nk, not (c_nationkey < 4 or c_nationkey between 8 and 12) ok from customer)""",
    "varchar_trim": """select p_partkey k, case when p_size < 15 then 'ab  ' when p_size >= 30 then 'ab ' end v,
        case when p_size between 15 and 29 then 'v:length' else '' end problems from part""",
    "standardize_hook": """select c_custkey, upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) || ', '
        || upper(c_name) std from customer""",
    "standardize_memo": """select c_custkey, case when c_nationkey < 10 then 'known ' || c_nationkey
            when c_mktsegment = 'BUILDING' then ' ' || c_nationkey
            else upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) || ' ' || c_nationkey end std,
        (select count(distinct c_mktsegment || c_nationkey) from customer where c_nationkey >= 10) n_asked from customer""",
    "salted_resolve": "select f.admid, i.id identity_id from feed f left join ident i using (a, ci, st)",
    "reactivate_first_match": """select c.c_custkey id, case when c.c_acctbal < 0 and not coalesce(c.c_custkey = k.first_id, false)
        then true end inactive
        from customer c left join (
            select c_mktsegment, c_nationkey, min(c_custkey) first_id from customer x
            where exists (select 1 from customer y join orders on o_custkey = y.c_custkey
                where y.c_mktsegment = x.c_mktsegment and y.c_nationkey = x.c_nationkey
                  and y.c_mktsegment <> 'MACHINERY' and o_orderdate >= timestamp '1998-01-01')
            group by 1, 2) k on k.c_mktsegment = c.c_mktsegment and k.c_nationkey = c.c_nationkey""",
    "cycle_parcel_full": f"""select
        case when p.admid is null then (select coalesce(max(id), 0) from ppar)
             + row_number() over (partition by p.admid is null order by coalesce(p.admid, m.admid)) else p.id end id,
        coalesce(m.admid, p.admid) admid, {', '.join(f'm.{c}' for c in _PARCEL_FROM_FEED)},
        case when m.admid is null then '00000' else m.parcel_fips end parcel_fips,
        case when m.admid is null then 'PROD' else m.record_type end record_type,
        case when m.admid is null then cast(floor(p.price) as bigint) else m.total_value end total_value,
        cast(null as boolean) parcel_privacy, case when m.admid is null then p.flag end rental_flag,
        case when m.admid is not null then {_normalize_sql(_MATCH_TEXT)} end parcel_match_address,
        case when {_HAS_POINT} then cast(m.parcel_longitude as double) end parcel_location_lon,
        case when {_HAS_POINT} then cast(m.parcel_latitude as double) end parcel_location_lat,
        case when {_HAS_POINT} then 4326 end parcel_location_srid,
        case when m.admid is null then p.entity_id else n.entity_id end entity_id,
        case when m.admid is null then p.identity_id else n.identity_id end identity_id
        from ppar p full join month_parcel m on p.admid = m.admid left join dfk n on n.admid = m.admid
        qualify coalesce(m.admid, p.admid) not in (select admid from del)""",
    "cycle_identity_full": """select i.id, i.a mail_address, i.ci mail_city, i.st mail_state, v.zip mail_zipcode,
        v.verified mail_verified, v.lon mail_longitude, v.lat mail_latitude, v.geo mail_geoquality, v.rdi rdi,
        case when v.a is not null then '' end primary_name, cast(case when v.a is not null then 0 end as smallint) rental_count,
        case when i.id not in (select identity_id from par3) then true
             when i.inactive and exists (select 1 from d where d.a = i.a and d.ci = i.ci and d.st = i.st) then null
             else i.inactive end inactive,
        cast(v.lon as double) mail_location_lon, cast(v.lat as double) mail_location_lat,
        case when v.a is not null then 4326 end mail_location_srid
        from id2 i left join month_survivor v on v.a = i.a and v.ci = i.ci and v.st = i.st
            and i.id > (select coalesce(max(id), 0) from pid)""",
    "cycle_entity_full": """select e.id, e.owner, substr(e.owner, 1, 8) owner1_firstname,
        substr(e.owner, 10, 9) owner1_lastname, 'S' || n_nationkey owner2_firstname, i.ci owner2_lastname,
        i.st coowner, substr(i.st, 1, 3) coowner1_firstname, substr(i.st, 4, 9) coowner1_lastname,
        substr(i.ci, 1, 3) coowner2_firstname, substr(i.a, 1, 4) coowner2_lastname, e.identity_id
        from ent2 e join id2 i on i.id = e.identity_id join nation on n_name = i.ci
        where e.id in (select entity_id from par3)""",
    "trio_flatten": """select d.admid, i.id identity_id, e.id entity_id, d.a mail_address, d.ci mail_city,
        d.st mail_state, i.lon mail_longitude, i.verified mail_verified, d.owner, 'P-' || d.c_custkey parcel_number
        from d join (select row_number() over (order by a, ci, st) id, * from month_survivor) i using (a, ci, st)
        join (select row_number() over (order by owner, coowner, owner1_first, owner1_last, owner2_first, owner2_last,
                  coowner1_first, coowner1_last, coowner2_first, coowner2_last, identity_id) id, owner, identity_id
              from (select distinct d.owner, d.st coowner, substr(d.owner, 1, 8) owner1_first,
                        substr(d.owner, 10, 9) owner1_last, 'S' || d.nk owner2_first, d.ci owner2_last,
                        substr(d.st, 1, 3) coowner1_first, substr(d.st, 4, 9) coowner1_last,
                        substr(d.ci, 1, 3) coowner2_first, substr(d.a, 1, 4) coowner2_last, k.id identity_id
                    from d join (select row_number() over (order by a, ci, st) id, a, ci, st from month_survivor) k
                    using (a, ci, st))) e
            on e.owner = d.owner and e.identity_id = i.id""",
    "trio_checks": """select 'parcel' "table", 'not_null' rule, 'record_type' detail, count(*) n from d
        where stat = 'P' having count(*) > 0
        union all select 'parcel', 'length', 'parcel_state|' || length(st), count(*) from d group by 3""",
    "cycle_postcards": """select distinct l_orderkey * 8 + l_linenumber id,
        case when l_orderkey not in (select admid from del) then p.id end parcel_id
        from lineitem join ppar p on p.admid = l_orderkey""",
    "check_not_null": "select c_custkey, 'c_mktsegment' col from customer where nullif(c_mktsegment, 'BUILDING') is null",
    "check_fk": """select l_orderkey, l_partkey, l_linenumber from lineitem
        where not exists (select 1 from orders where o_orderkey = l_orderkey and o_orderstatus <> 'P')""",
    "cascade_delete": """select l_orderkey, l_partkey, l_linenumber from lineitem
        where l_orderkey not in (select o_orderkey from orders where o_orderpriority = '1-URGENT')""",
    "reactivate_identity": """select id, case when inactive and exists (select 1 from d where d.a = pid.a and d.ci = pid.ci and d.st = pid.st)
        then null else inactive end inactive from pid""",
    "entity_insert": "select id, owner, identity_id from ent2 where id > (select max(id) from pent)",
    "upsert_parcel": "select admid, price, identity_id, entity_id from par2",
    "upsert_actions": "select admid, op from par2",
    "upsert_bucketed": """select case when p.admid is null then (select coalesce(max(id), 0) from ppar)
             + row_number() over (partition by p.admid is null order by coalesce(p.admid, n.admid)) else p.id end id,
        x.admid, x.price, x.flag, x.identity_id, x.entity_id, x.op, x.admid in (select admid from del) gone
        from par2 x left join ppar p on p.admid = x.admid left join dfk n on n.admid = x.admid""",
    "upsert_null_keys": """select case when s.k is null then (select coalesce(max(id), 0) from nk_state)
             + row_number() over (partition by s.k is null order by n.k nulls last, n.c) else s.id end id,
        coalesce(n.k, s.k) k, coalesce(n.c, s.c) c,
        case when s.k is null then 'insert' when n.c is null then 'keep' else 'update' end op
        from nk_state s full join nk_delta n on n.k = s.k""",
    "upsert_then_delete": "select admid, price, op from par3",
    "deactivate_identities": """select id, case when id not in (select identity_id from par3) then true
        else case when inactive and exists (select 1 from d where d.a = id2.a and d.ci = id2.ci and d.st = id2.st)
        then null else inactive end end inactive from id2""",
    "sweep_incremental": """select c_custkey id, case when c_custkey not in (select cust from sweep_0)
            or c_custkey not in (select cust from sweep_1) or c_custkey not in (select cust from sweep_2)
            or c_custkey not in (select cust from sweep_3) then true end inactive,
        (select count(*) from sweep_3 where cust = c_custkey) n from customer""",
    "drop_orphan_entities": "select id, owner, identity_id from ent2 where id in (select entity_id from par3)",
    "cycle_from_files": """select admid, cast(floor(price) as bigint) price, identity_id, entity_id from par3""",
    "full_cycle": """select p.admid, p.price, p.identity_id, p.entity_id, e.owner, i.a, i.ci, i.st, i.attr
        from par3 p join id2 i on i.id = p.identity_id join ent2 e on e.id = p.entity_id""",
}

ORACLE_SQL = {name: _with(sql) for name, sql in QUERIES.items()}
