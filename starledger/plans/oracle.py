"""Oracle SQL (DuckDB dialect) for every registered query.

The role-view text mirrors :mod:`starledger.plans.roles` clause by
clause; the operators are written the plain SQL way (unions, window
``row_number``/``rank``, ``left join``), so the two sides are computed
independently."""

from __future__ import annotations

ET = "['click','error','purchase','signup','view']"


def txn(customer: bool = False, supplier: bool = False, part: bool = False) -> str:
    cols = [
        "concat_ws('_', l_orderkey, l_partkey, l_suppkey, l_linenumber) as transaction_unique_key",
        "cast(l_orderkey as varchar) as award_unique_key",
        "case when l_linestatus = 'F' then 'assistance' else 'contract' end as award_type",
        "cast(l_shipdate as date) as action_date",
        "cast(o_orderdate as date) as last_modified_date",
        "cast(l_extendedprice as decimal(18,2)) as total_obligated_amount",
        "cast(o_totalprice as decimal(18,2)) as total_face_value_of_loan",
        "cast(o_custkey as varchar) as recipient_uei",
        "l_returnflag as business_size_code",
        "case when o_orderpriority <> '5-LOW' then o_orderpriority end as primary_place_of_performance_scope",
        f"{ET}[(l_suppkey % 5) + 1] || '-' || lpad(cast(l_partkey % 4 as varchar), 2, '0') "
        "as prime_award_transaction_recipient_cd_original",
        f"{ET}[(o_custkey % 5) + 1] || '-' || lpad(cast(l_linenumber % 6 as varchar), 2, '0') "
        "as prime_award_transaction_place_of_performance_cd_original",
    ]
    joins = "lineitem join orders on l_orderkey = o_orderkey"
    if customer:
        joins += " join customer on o_custkey = c_custkey join nation cn on c_nationkey = cn.n_nationkey"
        cols += ["cast(c_nationkey as varchar) as awarding_agency_code", "cn.n_name as awarding_agency_name",
                 "c_name as recipient_name_raw",
                 "lpad(cast(c_nationkey as varchar), 5, '0') as prime_award_transaction_recipient_county_fips_code",
                 "cn.n_name as recipient_county_name"]
    if supplier:
        joins += " join supplier on l_suppkey = s_suppkey join nation sn on s_nationkey = sn.n_nationkey"
        cols += ["cast(s_nationkey as varchar) as funding_agency_code", "sn.n_name as funding_agency_name",
                 "lpad(cast(s_nationkey as varchar), 5, '0') "
                 "as prime_award_transaction_place_of_performance_county_fips_code",
                 "sn.n_name as primary_place_of_performance_county_name"]
    if part:
        joins += " join part on l_partkey = p_partkey"
        cols += ["p_brand as naics_code", "case when p_type <> 'ECONOMY' then p_type end as naics_description"]
    return "select " + ",\n  ".join(cols) + "\nfrom " + joins


def dkey(c: str) -> str:
    return f"(year({c}) * 10000 + month({c}) * 100 + day({c}))"


# Star fact with date keys (all role dates lie inside the derived calendar).
def fact(customer: bool = False, supplier: bool = False) -> str:
    return f"select *, {dkey('action_date')} as action_date_key, " \
           f"{dkey('last_modified_date')} as last_modified_key from ({txn(customer, supplier)})"


FACT = fact()
FACT_CS = fact(True, True)
FACT_C = fact(customer=True)

ASSIST = "a as (select transaction_unique_key, total_face_value_of_loan from t where award_type = 'assistance')"

AGENCY = """select distinct * from (
  select awarding_agency_code as agency_code, awarding_agency_name as agency_name from t
  union all select funding_agency_code, funding_agency_name from t)
where agency_code is not null and agency_name is not null"""

NAICS = f"""c as (select * from ({txn(part=True)}) where award_type = 'contract'),
nd as (select naics_code, naics_description,
         row_number() over (order by naics_code nulls first, naics_description nulls first) as naics_key
       from (select distinct naics_code, naics_description from c where naics_code is not null)),
cf as (select transaction_unique_key, naics_key,
         case when business_size_code = 'A' then 1 when business_size_code = 'R' then 2 end as business_size_key
       from c join nd using (naics_code, naics_description))"""

CALENDAR_DAYS = """b as (select min(least(action_date, last_modified_date)) as lo,
                 max(greatest(action_date, last_modified_date)) as hi from t),
fy as (select case when month(lo) >= 10 then year(lo) + 1 else year(lo) end as f0,
              case when month(hi) >= 10 then year(hi) + 1 else year(hi) end as f1 from b),
days as (select cast(unnest(generate_series(cast(make_date(f0 - 1, 10, 1) as timestamp),
                 cast(make_date(f1, 10, 1) as timestamp) - interval 1 day, interval 1 day)) as date) as d from fy)"""

HOUSE = """h as (select 2014 + 2 * (day(ts) % 5) as year, event_type as state_po,
              cast(hour(ts) % 4 as varchar) as district, cast(user_id as varchar) as candidate,
              'party ' || cast(event_id % 3 as varchar) as party, cast(value as decimal(18,2)) as candidatevotes from events),
hl as (select year, state_po, district, candidate, party, max(candidatevotes) as votes
       from h where year >= 2018 group by all),
hr as (select *, rank() over (partition by year, state_po, district order by votes desc) as rk from hl),
w as (select year, state_po, district, candidate, party from hr where rk = 1),
parties as (select concat_ws('-', state_po, lpad(district, 2, '0')) as congressional_district,
              party_2018, party_2020, party_2022
            from (select state_po, district, party as party_2018 from w where year = 2018)
            full join (select state_po, district, party as party_2020 from w where year = 2020)
              using (state_po, district)
            full join (select state_po, district, party as party_2022 from w where year = 2022)
              using (state_po, district))"""

INITCAP = "array_to_string(list_transform(string_split({x}, ' '), " \
          "lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ')"

PRES = f"""p as (select case when day(ts) % 2 = 0 then 2016 else 2020 end as year,
              lpad(cast(user_id % 25 as varchar), 5, '0') as county_fips, event_type as candidate,
              event_type || ' party' as party, cast(value as decimal(18,2)) as candidatevotes from events),
pd as (select distinct * from p where year in (2016, 2020)),
tot as (select year, county_fips, candidate, party, sum(candidatevotes) as total from pd group by all),
mx as (select year, county_fips, max(total) as total from tot group by all),
pw as (select year, county_fips, {INITCAP.format(x='party')} as party from mx join tot using (year, county_fips, total)),
pres as (select county_fips, min(case when year = 2016 then party end) as party_2016,
                min(case when year = 2020 then party end) as party_2020 from pw group by county_fips)"""

COUNTY = f"""county as (select distinct * from (
    select prime_award_transaction_recipient_county_fips_code as county_fips, recipient_county_name as county_name from t
    union all select prime_award_transaction_place_of_performance_county_fips_code,
                     primary_place_of_performance_county_name from t)
  where county_fips is not null and county_name is not null),
gdp as (select lpad(cast(s_nationkey as varchar), 5, '0') as fips_code,
          cast(floor(sum(cast(s_acctbal as decimal(18,2)))) as bigint) as gdp_2022
        from supplier where s_nationkey % 5 <> 2 group by s_nationkey),
pop as (select lpad(cast(c_nationkey as varchar), 5, '0') as fips_code, count(*) as popestimate2019,
          count(*) + 1 as popestimate2020, count(*) + 2 as popestimate2021, count(*) + 3 as popestimate2022
        from customer group by c_nationkey),
{PRES},
ce as (select county.county_fips, gdp_2022, popestimate2019, popestimate2020, popestimate2021, popestimate2022, party_2016, party_2020 from county
       join gdp on county.county_fips = gdp.fips_code
       join pop on county.county_fips = pop.fips_code
       join pres on county.county_fips = pres.county_fips)"""

DISTRICTS = """cd as (select cd_original, row_number() over (order by cd_original) as cd_code from (
    select distinct cd_original from (
      select prime_award_transaction_recipient_cd_original as cd_original from t
      union all select prime_award_transaction_place_of_performance_cd_original from t)
    where cd_original is not null))"""

SLOTS = """slots as (select l_orderkey, """ + ", ".join(
    f"min(case when l_linenumber = {i} then s_name end) as n{i}" for i in range(1, 6)) + """
  from lineitem join supplier on l_suppkey = s_suppkey group by l_orderkey),
f as (select concat_ws('_', l_orderkey, l_partkey, l_suppkey, l_linenumber) as transaction_unique_key, """ + \
    ", ".join(f"n{i}" for i in range(1, 6)) + """ from lineitem join slots using (l_orderkey)),
hco as (select hco_name, row_number() over (order by hco_name) as hco_code from (
    select distinct hco_name from (""" + " union all ".join(f"select n{i} as hco_name from f" for i in range(1, 6)) + """)
    where hco_name is not null))"""

ORACLE: dict[str, str] = {}

ORACLE["clean_cast_money"] = """
with raw as (
  select case when l_linenumber <> 7 then concat_ws('_', l_orderkey, l_partkey, l_suppkey, l_linenumber) end
           as transaction_unique_key,
         case when l_orderkey % 10 = 0 then 'n/a' when l_orderkey % 10 = 1 then null
              else cast(cast(l_extendedprice as decimal(18,2)) as varchar) end as fao,
         case when l_partkey % 3 = 0 then cast(cast(l_quantity as decimal(18,2)) as varchar) || '5'
              when l_partkey % 3 = 1 then 'abc' end as toa,
         cast(year(l_shipdate) as varchar) as fy
  from lineitem),
typed as (select transaction_unique_key, try_cast(fao as decimal(18,2)) as fao, try_cast(toa as decimal(18,2)) as toa,
                 try_cast(fy as bigint) as fy from raw)
select transaction_unique_key, cast(fao as double) as federal_action_obligation,
       cast(toa as double) as total_obligated_amount, fy as action_date_fiscal_year
from typed where transaction_unique_key is not null and (fao is not null or toa is not null)"""

ORACLE["clean_key_shape"] = """
select * from (
  select concat_ws('_', l_orderkey, l_partkey, case when l_linenumber <> 2 then l_suppkey end, l_linenumber,
                   case when l_linenumber <> 3 then l_returnflag else '' end) as transaction_unique_key,
         l_extendedprice
  from lineitem)
where regexp_matches(transaction_unique_key, '.+_.+_.+_.+_.+')"""

ORACLE["clean_grouped_int"] = """
select lpad(cast(o_custkey as varchar), cast(greatest(5, length(cast(o_custkey as varchar))) as integer), '0') as fips_code, o_orderkey,
       cast(round_even(o_totalprice, 0) as bigint) as gdp_2022
from orders"""

ORACLE["project_present"] = """
select c_custkey as recipient_uei, c_name as recipient_name_raw, c_mktsegment, 'customer' as award_type,
       cast(floor(c_acctbal * 100) as bigint) as balance_cents
from customer"""

ORACLE["code_to_key"] = f"""
select distinct cast(case when business_size_code = 'A' then 1 when business_size_code = 'R' then 2 end as bigint)
         as business_size_key,
       business_size_code, 'size ' || business_size_code as business_size
from ({txn()}) where award_type = 'contract' and business_size_code in ('A', 'R')"""

ORACLE["filters_basic"] = """
select c_custkey, c_name, cast(c_nationkey as bigint) as c_nationkey from (
  select c_custkey, case when c_custkey % 11 <> 0 then c_name end as c_name, c_nationkey, c_acctbal, c_mktsegment
  from customer)
where c_nationkey in (1, 5, 7) and c_acctbal >= 0 and c_mktsegment <> 'BUILDING' and c_name is not null"""

ORACLE["fips_pad"] = """
select c_custkey,
       lpad(cast(c_nationkey as varchar), 2, '0') || lpad(cast(c_custkey % 1000 as varchar), 3, '0') as fips_code,
       case when length(cast(c_nationkey as varchar)) < 2 then '0' || cast(c_nationkey as varchar)
            else cast(c_nationkey as varchar) end as one_zero_code,
       lpad(cast(c_custkey as varchar), cast(greatest(3, length(cast(c_custkey as varchar))) as integer), '0') as padded_code,
       concat_ws('-', r_name, lpad(cast(c_nationkey as varchar), 2, '0')) as district_code,
       concat_ws('-', case when c_custkey % 2 = 0 then r_name end, lpad(cast(c_custkey % 100 as varchar), 2, '0'))
         as district_code_nulls
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""

ORACLE["union_families"] = f"""
with t as ({txn()})
select transaction_unique_key, award_unique_key, cast(total_obligated_amount as double) as total_obligated_amount,
       action_date, award_type from t where award_type = 'assistance'
union all
select transaction_unique_key, award_unique_key,
       cast(try_cast(cast(total_obligated_amount as varchar) as decimal(18,2)) as double), action_date, award_type
from t where award_type = 'contract'"""

ORACLE["merge_increment"] = """
with r as (select cast(l_orderkey as varchar) as award_unique_key, year(l_shipdate) as action_date_fiscal_year,
                  l_returnflag from lineitem)
select distinct award_unique_key, cast(action_date_fiscal_year as bigint) as action_date_fiscal_year, l_returnflag
from (select * from r where action_date_fiscal_year <= 1997
      union all select * from r where action_date_fiscal_year >= 1997)"""

ORACLE["dim_natural"] = f"""
select distinct naics_code as cfda_number, naics_description as cfda_title
from ({txn(part=True)}) where award_type = 'assistance' and naics_code is not null and naics_description is not null"""

ORACLE["dim_two_roles"] = f"""
with t0 as ({txn(True, True)}),
t as (select awarding_agency_code, case when awarding_agency_name <> 'NATION_3' then awarding_agency_name end
               as awarding_agency_name, funding_agency_code, funding_agency_name from t0)
{AGENCY}"""

ORACLE["dim_five_roles"] = f"""
with {SLOTS}
select hco_name, hco_code from hco"""

ORACLE["dim_dense_rekey_inner"] = f"""
with {NAICS}
select transaction_unique_key, naics_key from cf"""

ORACLE["dim_dense_desc"] = f"""
with c as (select * from ({txn(supplier=True)}) where award_type = 'contract'),
d as (select distinct funding_agency_code, funding_agency_name from c
      where funding_agency_code is not null and funding_agency_name is not null)
select row_number() over (order by funding_agency_code desc nulls last, funding_agency_name nulls first)
         as country_of_origin_key,
       funding_agency_code as country_of_origin_code, funding_agency_name as country_of_origin
from d"""

ORACLE["dim_rekey_left"] = f"""
with a as (select * from ({txn()}) where award_type = 'assistance'),
d as (select s, row_number() over (order by s) as k from (
        select distinct primary_place_of_performance_scope as s from a where primary_place_of_performance_scope is not null))
select transaction_unique_key, k as primary_place_of_performance_scope_code
from a left join d on a.primary_place_of_performance_scope = d.s"""

ORACLE["calendar"] = f"""
with t as ({txn()}),
{CALENDAR_DAYS}
select cast({dkey('d')} as bigint) as date_key, d as calendar_date, year(d) as calendar_year,
       strftime(d, '%B') as calendar_month, month(d) as month_of_year, strftime(d, '%A') as calendar_day,
       dayofweek(d) + 1 as day_of_week, case when isodow(d) < 6 then 'Y' else 'N' end as is_weekday,
       day(d) as day_of_month, case when d = last_day(d) then 'Y' else 'N' end as last_day_of_month,
       weekofyear(d) as week_of_year_iso, quarter(d) as quarter_of_year,
       case when month(d) >= 10 then year(d) + 1 else year(d) end as fiscal_year,
       (month(d) + 2) % 12 + 1 as fiscal_month
from days"""

ORACLE["role_dates"] = f"""
with t as ({txn()}),
{CALENDAR_DAYS},
cal as (select d, {dkey('d')} as k from days)
select transaction_unique_key, c1.k as action_date_key, c2.k as last_modified_key
from t left join cal c1 on t.action_date = c1.d left join cal c2 on t.last_modified_date = c2.d"""

ORACLE["role_pair"] = f"""
with t as ({txn()}),
{DISTRICTS}
select transaction_unique_key, c1.cd_code as recipient_cd_code, c2.cd_code as place_of_performance_cd_code
from t left join cd c1 on t.prime_award_transaction_recipient_cd_original = c1.cd_original
       left join cd c2 on t.prime_award_transaction_place_of_performance_cd_original = c2.cd_original"""

ORACLE["role_five"] = f"""
with {SLOTS}
select transaction_unique_key, """ + ", ".join(
    f"d{i}.hco_code as highly_compensated_officer_{i}_code" for i in range(1, 6)) + """
from f """ + " ".join(f"left join hco d{i} on f.n{i} = d{i}.hco_name" for i in range(1, 6))

ORACLE["role_pair_unpivot"] = ORACLE["role_pair"]
ORACLE["role_five_unpivot"] = ORACLE["role_five"]

ORACLE["winner_rank"] = f"""
with {HOUSE}
select cast(year as bigint) as year, state_po, district, candidate, party from w"""

ORACLE["winner_outer_years"] = f"""
with {HOUSE}
select * from parties"""

ORACLE["winner_pivot_years"] = f"""
with {HOUSE}
select concat_ws('-', state_po, lpad(district, 2, '0')) as congressional_district,
       min(case when year = 2018 then party end) as party_2018,
       min(case when year = 2020 then party end) as party_2020,
       min(case when year = 2022 then party end) as party_2022
from w group by state_po, district"""

ORACLE["winner_sum_lines"] = f"""
with {HOUSE},
lines as (select year, state_po, district, candidate, party, candidatevotes,
                 row_number() over (partition by year, state_po, district, candidate
                                    order by candidatevotes desc, party desc) as pick
          from h where year >= 2018),
cand as (select year, state_po, district, candidate, sum(candidatevotes) as votes,
                max(case when pick = 1 then party end) as party
         from lines group by year, state_po, district, candidate),
ranked as (select *, rank() over (partition by year, state_po, district order by votes desc) as rk from cand)
select cast(year as bigint) as year, state_po, district, candidate, party from ranked where rk = 1"""

ORACLE["dim_state_tagged"] = f"""
with t as ({txn(True, True)})
select distinct * from (
  select substr(awarding_agency_name, 1, 2) as state_abbreviation, awarding_agency_name as state_name,
         'letters' as code_system from t
  union all
  select lpad(funding_agency_code, 2, '0'), funding_agency_name, 'fips' from t)
where state_abbreviation is not null and state_name is not null"""

ORACLE["winner_joinback_pivot"] = f"""
with {PRES}
select * from pres"""

ORACLE["enrich_county"] = f"""
with t as ({txn(True, True)}),
{COUNTY}
select * from ce"""

ORACLE["enrich_district"] = f"""
with t as ({txn()}),
{DISTRICTS},
{HOUSE}
select cd_original, cd_code, party_2018, party_2020, party_2022
from cd join parties on cd.cd_original = parties.congressional_district"""

ORACLE["resolve_by_name"] = """
with codes as (select lpad(cast(n_regionkey as varchar), 2, '0') as state, lpad(cast(n_nationkey as varchar), 3, '0')
                 as county, r_name as stname, n_name || ' County' as ctyname
               from nation join region on n_regionkey = r_regionkey),
g as (select r_name as state, n_name as county, cast(floor(sum(cast(s_acctbal as decimal(18,2)))) as bigint) as g
      from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
      group by r_name, n_name),
ref as (select state || county as fips_code, stname, replace(ctyname, ' County', '') as ctyname from codes)
select fips_code, stname, ctyname, cast(1000 as bigint) as gdp_2019, cast(null as bigint) as gdp_2020,
       cast(3000000000 as bigint) as gdp_2021, g as gdp_2022
from g join ref on g.state = ref.stname and g.county = ref.ctyname"""

ORACLE["merge_vintages"] = """
with j as (select * from orders join customer on o_custkey = c_custkey),
a as (select c_nationkey as state, c_custkey as county, count(*) as popestimate2019 from j
      where year(o_orderdate) % 2 = 0 group by all),
b as (select c_nationkey as state, c_custkey as county, count(*) as popestimate2020 from j
      where year(o_orderdate) % 2 = 1 group by all)
select popestimate2019, popestimate2020,
       lpad(cast(state as varchar), 2, '0')
         || lpad(cast(county as varchar), cast(greatest(3, length(cast(county as varchar))) as integer), '0') as fips_code
from a join b using (state, county)"""

ORACLE["summary_totals_by_day"] = f"""
with t as ({FACT})
select cast(action_date_key as bigint) as action_date_key, count(transaction_unique_key) as number_of_transactions
from t group by all"""

ORACLE["summary_by_award"] = f"""
with t as ({FACT}), {ASSIST}
select t.award_unique_key, cast(max(t.total_obligated_amount) as double) as total_obligated_amount,
       cast(max(a.total_face_value_of_loan) as double) as total_face_value_of_loan,
       cast(min(t.action_date_key) as bigint) as initial_action_date_key
from t join a using (transaction_unique_key) group by t.award_unique_key"""

ORACLE["summary_agencies_day"] = f"""
with t as ({FACT_CS}), agency as ({AGENCY})
select cast(action_date_key as bigint) as action_date_key, agency_name, count(agency_code) as agency_count
from t join agency on agency.agency_code = t.funding_agency_code group by all"""

ORACLE["summary_agencies_month"] = f"""
with t as ({FACT_CS}), agency as ({AGENCY})
select strftime(action_date, '%B') as calendar_month, agency_name, count(agency_code) as agency_count
from t join agency on agency.agency_code = t.funding_agency_code group by all"""

ORACLE["summary_agencies_month_year"] = f"""
with t as ({FACT_CS}), agency as ({AGENCY})
select strftime(action_date, '%B %Y') as calendar_year_month, agency_name, count(agency_code) as agency_count
from t join agency on agency.agency_code = t.funding_agency_code group by all"""

ORACLE["summary_industries_day"] = f"""
with t as ({FACT}), {NAICS}
select cast(t.action_date_key as bigint) as action_date_key, nd.naics_code, nd.naics_description,
       count(nd.naics_key) as industry_count
from t join cf using (transaction_unique_key) join nd using (naics_key) group by all"""

ORACLE["summary_industries_month"] = f"""
with t as ({FACT}), {NAICS}
select strftime(t.action_date, '%B') as calendar_month, nd.naics_code, nd.naics_description,
       count(nd.naics_key) as industry_count
from t join cf using (transaction_unique_key) join nd using (naics_key) group by all"""

ORACLE["summary_small_business_day"] = f"""
with t as ({FACT}), {NAICS}
select cast(action_date_key as bigint) as action_date_key,
       count(case when business_size_key = 1 then 1 end) as small_business_transactions,
       count(business_size_key) as total_transactions
from t join cf using (transaction_unique_key) group by all"""

ORACLE["summary_small_business_month"] = f"""
with t as ({FACT}), {NAICS}
select strftime(action_date, '%B') as calendar_month,
       count(case when business_size_key = 1 then 1 end) as small_business_transactions,
       count(business_size_key) as total_transactions
from t join cf using (transaction_unique_key) group by all"""

ORACLE["summary_by_county"] = f"""
with t as ({FACT_CS}),
{COUNTY},
names as (select lpad(cast(n_nationkey as varchar), 5, '0') as fips_code, n_name as ctyname, r_name as stname
          from nation join region on n_regionkey = r_regionkey),
cty as (select ce.*, ctyname, stname from ce join names on ce.county_fips = names.fips_code)
select t.prime_award_transaction_recipient_county_fips_code, ctyname as county_name, stname as state_name,
       gdp_2022, popestimate2019, popestimate2020, popestimate2021, popestimate2022, count(t.total_obligated_amount) as obligation_count,
       cast(sum(t.total_obligated_amount) as double) as obligation_sum
from t join cty on t.prime_award_transaction_recipient_county_fips_code = cty.county_fips group by all"""

ORACLE["summary_recipients"] = f"""
with t as ({FACT_C}),
r as (select distinct recipient_uei, recipient_name_raw from t
      where recipient_uei is not null and recipient_name_raw is not null)
select cast(t.action_date_key as bigint) as action_date_key, r.recipient_name_raw,
       count(r.recipient_uei) as recipient_count
from t join r on r.recipient_uei = t.recipient_uei group by all"""

ORACLE["summary_recipients_month"] = f"""
with t as ({FACT_C}),
r as (select distinct recipient_uei, recipient_name_raw from t
      where recipient_uei is not null and recipient_name_raw is not null)
select strftime(t.action_date, '%B') as calendar_month, r.recipient_name_raw,
       count(r.recipient_uei) as recipient_count
from t join r on r.recipient_uei = t.recipient_uei group by all"""

ORACLE["award_by_date"] = f"""
with t as ({FACT}), {ASSIST}
select award_unique_key, cast(action_date_key as bigint) as action_date_key,
       cast(total_obligated_amount as double) as total_obligated_amount,
       cast(total_face_value_of_loan as double) as total_face_value_of_loan
from (select distinct t.award_unique_key, t.action_date_key, t.total_obligated_amount, a.total_face_value_of_loan
      from t join a using (transaction_unique_key))"""

ORACLE["award_sums_by_day"] = f"""
with t as ({FACT}), {ASSIST},
abd as (select distinct t.award_unique_key, t.action_date_key, t.total_obligated_amount, a.total_face_value_of_loan
        from t join a using (transaction_unique_key))
select cast(action_date_key as bigint) as action_date_key,
       cast(sum(total_obligated_amount) as double) as total_obligated_amount,
       cast(sum(total_face_value_of_loan) as double) as total_face_value_of_loan
from abd group by all"""

ORACLE["award_sums_dedup"] = f"""
with t as ({FACT}), {ASSIST},
j as (select t.transaction_unique_key, t.award_unique_key, t.action_date_key, t.total_obligated_amount,
             a.total_face_value_of_loan
      from t join a using (transaction_unique_key) where t.action_date_key is not null),
r as (select *, row_number() over (partition by award_unique_key, action_date_key
                                   order by total_obligated_amount nulls first, transaction_unique_key nulls first,
                                            total_face_value_of_loan nulls first) as rn from j)
select cast(action_date_key as bigint) as action_date_key, award_unique_key,
       cast(sum(total_obligated_amount) as double) as total_obligated_amount,
       cast(sum(total_face_value_of_loan) as double) as total_face_value_of_loan
from r where rn = 1 group by all"""

ORACLE["mask_columns"] = """
with r as (select cast(c_custkey as varchar) as recipient_uei,
                  case when c_custkey % 13 <> 0 then c_name end as recipient_name_raw from customer)
select recipient_uei, recipient_name_raw, 'data engineer' as principal from r
union all
select recipient_uei, case when recipient_name_raw is not null then 'xxxx' end, 'NATION_7' from r"""

ORACLE["mask_officers"] = f"""
with {SLOTS}
select hco_name, hco_code, 'data engineer' as principal from hco
union all
select case when hco_name is not null then 'xxxx' end, hco_code, 'NATION_7' from hco"""

ORACLE["row_filter"] = f"""
with t as ({txn(True, True)}), agency as ({AGENCY}),
fr as (select transaction_unique_key, awarding_agency_code, recipient_uei, recipient_name_raw from t)
select *, 'data engineer' as principal from fr
union all
select transaction_unique_key, awarding_agency_code, recipient_uei,
       case when recipient_name_raw is not null then 'xxxx' end, 'NATION_7'
from fr where awarding_agency_code in (select agency_code from agency where agency_name = 'NATION_7')
union all
select transaction_unique_key, awarding_agency_code, recipient_uei,
       case when recipient_name_raw is not null then 'xxxx' end, 'Agency1'
from fr where awarding_agency_code in (select agency_code from agency where agency_name = 'Agency1')"""

ORACLE["row_filter_agency"] = f"""
with t as ({txn(True, True)}), agency as ({AGENCY})
select *, 'data engineer' as principal from agency
union all select *, 'NATION_7' from agency where agency_name = 'NATION_7'
union all select *, 'Agency1' from agency where agency_name = 'Agency1'"""

ORACLE["csv_roundtrip"] = """
select o_orderkey, cast(cast(o_totalprice as decimal(18,2)) as double) as o_totalprice,
       cast(o_orderdate as date) as o_orderdate, o_orderpriority
from orders where year(o_orderdate) = 1997"""

ORACLE["summary_incremental"] = f"""
with t as ({FACT_CS}), agency as ({AGENCY}),
j as (select * from t join agency on agency.agency_code = t.funding_agency_code)
select 'total' as kind, cast(action_date_key as varchar) as period, cast(null as varchar) as name, count(*) as n
from t group by all
union all select 'day', cast(action_date_key as varchar), agency_name, count(*) from j group by all
union all select 'month', strftime(action_date, '%B %Y'), agency_name, count(*) from j group by all"""

ORACLE["csv_schema_drift"] = """
select o_orderkey, cast(cast(o_totalprice as decimal(18,2)) as double) as o_totalprice,
       cast(o_orderdate as date) as o_orderdate,
       case when year(o_orderdate) % 3 < 2 then o_orderpriority end as o_orderpriority,
       case when year(o_orderdate) % 3 = 2 then o_orderstatus end as o_orderstatus
from orders"""

ORACLE["stable_keys"] = """
with o as (select cast(o_custkey as varchar) as recipient_uei, cast(o_totalprice as decimal(18,2)) as total,
                  case when o_orderdate < date '1995-02-01' then 1 when o_orderdate < date '1995-06-01' then 2 else 3 end as load
           from orders),
r as (select recipient_uei, min(load) as load, count(*) as n_orders, cast(sum(total) as double) as total
      from o group by recipient_uei)
select recipient_uei, row_number() over (order by load, recipient_uei) as recipient_key, cast(load as bigint) as load,
       n_orders, total from r"""

ORACLE["keyed_upsert"] = f"""
with t as (select transaction_unique_key as k, total_obligated_amount as a, last_modified_date as m, year(action_date) as fy,
                  (cast(award_unique_key as bigint) + cast(split_part(transaction_unique_key, '_', 4) as bigint)) % 10 as kind
           from ({txn()}))
select k as transaction_unique_key,
       cast(case when kind = 0 or kind = 3 and fy > 1996 then a + 1 else a end as double) as total_obligated_amount,
       cast(case when kind in (0, 2) then m + interval 30 day when kind = 3 and fy > 1996 then m - interval 5 day else m end
            as date) as last_modified_date,
       cast(case when kind = 2 then fy + 1 else fy end as bigint) as fiscal_year
from t where kind <> 1
qualify row_number() over (partition by k order by case when kind in (0, 2) then 0 when fy <= 1996 then 1 else 0 end desc,
                           a desc, fy desc) = 1"""

ORACLE["b2s_job"] = """
with j as (select * from lineitem join orders on l_orderkey = o_orderkey where l_linestatus = 'F'),
raw as (select concat_ws('_', l_orderkey, l_partkey, l_suppkey, l_linenumber,
                         case when l_returnflag <> 'N' then l_returnflag end) as k,
               cast(l_orderkey as varchar) as a,
               case when l_linenumber = 1 then 'junk' else cast(cast(l_extendedprice as decimal(18,2)) as varchar) end
                 as fao,
               case when l_linenumber <= 2 then cast(cast(o_totalprice as decimal(18,2)) as varchar) end as tfv,
               cast(cast(l_shipdate as date) as varchar) as ad, cast(year(l_shipdate) as varchar) as fy,
               o_orderpriority as scope from j),
typed as (select k, a, try_cast(fao as decimal(18,2)) as fao, try_cast(tfv as decimal(18,2)) as tfv,
                 try_cast(ad as date) as ad, try_cast(fy as bigint) as fy, scope from raw)
select k as transaction_unique_key, a as award_unique_key, cast(fao as double) as federal_action_obligation,
       cast(tfv as double) as total_face_value_of_loan, ad as action_date, fy as action_date_fiscal_year,
       scope as primary_place_of_performance_scope, 'assistance' as award_type
from typed where (fao is not null or tfv is not null) and k is not null and regexp_matches(k, '.+_.+_.+_.+_.+')"""

ORACLE["b2s_contract_job"] = """
with raw as (select concat_ws('_', l_orderkey, l_partkey, l_suppkey, l_linenumber, l_linestatus,
                              case when l_linenumber <> 5 then l_returnflag end) as k,
               cast(l_orderkey as varchar) as a,
               case when l_linenumber % 3 <> 0 then cast(cast(l_extendedprice as decimal(18,2)) as varchar) end as fao,
               case when l_linenumber = 2 then 'n/a'
                    when l_linenumber < 6 then cast(cast(l_quantity as decimal(18,2)) as varchar) end as toa,
               cast(l_shipdate as date) as ad, year(l_shipdate) as fy
             from lineitem where l_linestatus = 'O'),
typed as (select k, a, try_cast(fao as decimal(18,2)) as fao, try_cast(toa as decimal(18,2)) as toa, ad, fy from raw)
select k as transaction_unique_key, a as award_unique_key, cast(fao as double) as federal_action_obligation,
       cast(toa as double) as total_obligated_amount, ad as action_date, cast(fy as bigint) as action_date_fiscal_year,
       'contract' as award_type
from typed where (fao is not null or toa is not null) and regexp_matches(k, '.+_.+_.+_.+_.+_.+')"""

ORACLE["rejects_routed"] = """
with raw as (select case when l_orderkey % 11 <> 0 then concat_ws('_', l_orderkey, l_partkey, l_suppkey, l_linenumber,
                         l_linestatus, case when l_linenumber <> 5 then l_returnflag end) end as k,
               cast(l_orderkey as varchar) as a,
               case when l_linenumber % 3 <> 0 then cast(l_extendedprice as decimal(18,2)) end as fao,
               case when l_linenumber = 2 then 'n/a' when l_linenumber < 6 then cast(cast(l_quantity as decimal(18,2)) as varchar) end as t,
               case when l_orderkey % 13 <> 0 then year(l_shipdate) end as fy
        from lineitem where l_linestatus = 'O'),
typed as (select *, try_cast(t as decimal(18,2)) as toa from raw),
judged as (select *, concat_ws(',', case when fao is null and toa is null then 'no_money' end, case when k is null then 'no_key' end,
                               case when not regexp_matches(k, '.+_.+_.+_.+_.+_.+') then 'key_shape' end) as reasons from typed),
codes as (select 'reason' as kind, unnest(string_split(reasons, ',')) as code from judged where reasons <> ''
          union all select 'untyped', 'total_obligated_amount' from judged where t is not null and toa is null
          union all select 'untyped', 'action_date_fiscal_year' from judged where fy is null)
select case when reasons = '' then 'silver' else 'reject' end as outcome, k as transaction_unique_key, a as award_unique_key,
       cast(toa as double) as total_obligated_amount, cast(fy as bigint) as action_date_fiscal_year, reasons,
       case when reasons <> '' then t end as raw_amount from judged
union all select 'report', kind, code, null, count(*), '', null from codes group by kind, code"""

ORACLE["b2s_year_merge"] = f"""
with s as ({ORACLE["b2s_job"]})
select * from s where action_date_fiscal_year < 1996
union all select distinct * from s where action_date_fiscal_year >= 1996"""

ORACLE["gold_transactions"] = f"""
with t as ({txn(True, True)}),
{DISTRICTS},
{SLOTS}
select transaction_unique_key, award_type, cast(total_obligated_amount as double) as total_obligated_amount,
       cast({dkey('action_date')} as bigint) as action_date_key,
       cast({dkey('last_modified_date')} as bigint) as last_modified_key,
       c1.cd_code as recipient_cd_code, c2.cd_code as place_of_performance_cd_code, """ + ", ".join(
    f"d{i}.hco_code as highly_compensated_officer_{i}_code" for i in range(1, 6)) + """
from t join f using (transaction_unique_key)
     left join cd c1 on t.prime_award_transaction_recipient_cd_original = c1.cd_original
     left join cd c2 on t.prime_award_transaction_place_of_performance_cd_original = c2.cd_original
     """ + " ".join(f"left join hco d{i} on f.n{i} = d{i}.hco_name" for i in range(1, 6))

ORACLE["gold_dims"] = f"""
with t as ({txn(True, True)}),
{DISTRICTS},
{SLOTS},
{CALENDAR_DAYS},
letters as (select distinct substr(awarding_agency_name, 1, 2) as code, awarding_agency_name as name from t)
select 'DimAgency' as table_name, agency_code as code, agency_name as name from ({AGENCY})
union all select distinct 'DimRecipient', recipient_uei, recipient_name_raw from t
union all select 'DimCounty', c, null from (
  select prime_award_transaction_recipient_county_fips_code as c from t
  union select prime_award_transaction_place_of_performance_county_fips_code from t)
union all select 'DimCongressionalDistrict', cast(cd_code as varchar), cd_original from cd
union all select 'DimState', code, name from letters
union all select distinct 'DimState', lpad(funding_agency_code, 2, '0'), funding_agency_name from t
union all select 'DimStateLetters', code, name from letters
union all select 'DimHighlyCompensatedOfficer', cast(hco_code as varchar), hco_name from hco
union all select 'DimDate', cast({dkey('d')} as varchar), strftime(d, '%B') from days"""

GOLD_CONTRACTS = f"""c as (select * from ({txn(supplier=True, part=True)}) where award_type = 'contract'),
s as (select transaction_unique_key, award_unique_key, naics_code, naics_description,
             funding_agency_code as oc, case when funding_agency_name <> 'NATION_4' then funding_agency_name end as o,
             business_size_code from c),
nd as (select naics_code, naics_description,
         row_number() over (order by naics_code nulls first, naics_description nulls first) as naics_key
       from (select distinct naics_code, naics_description from s where naics_code is not null)),
s2 as (select * from s join nd using (naics_code, naics_description)),
od as (select oc, o, row_number() over (order by oc desc nulls last, o nulls first) as country_of_origin_key
       from (select distinct oc, o from s2 where oc is not null and o is not null)),
fc as (select transaction_unique_key, award_unique_key, naics_key, country_of_origin_key,
         cast(case when business_size_code = 'A' then 1 when business_size_code = 'R' then 2 end as bigint)
           as business_size_key
       from s2 join od using (oc, o))"""

ORACLE["gold_job"] = f"""
with {GOLD_CONTRACTS}
select * from fc"""


def _content(name: str, columns: str, source: str) -> str:
    """Rows, text, values and distinct rows of one published table."""
    cols = columns.split()
    text = "concat_ws('|', " + ", ".join(cols) + ")"
    present = " + ".join(f"({c} is not null)::int" for c in cols)
    return (f"select '{name}' as table_name, count(*) as row_count, sum(length({text}))::bigint as text_length, "
            f"sum({present})::bigint as values_present, count(distinct {text}) as distinct_rows from {source}")


ORACLE["publish_roundtrip"] = f"""
with t as ({txn(True, True)}), agency as ({AGENCY}),
rec as (select distinct recipient_uei, recipient_name_raw from t
        where recipient_uei is not null and recipient_name_raw is not null),
{GOLD_CONTRACTS},
bs as (select distinct case when business_size_code = 'A' then 1 when business_size_code = 'R' then 2 end
         as business_size_key, business_size_code, 'size ' || business_size_code as business_size
       from c where business_size_code in ('A', 'R')),
odp as (select country_of_origin_key, oc as country_of_origin_code, o as country_of_origin from od),
""" + """x as (select 1)
""" + "\nunion all ".join([
    _content("DimAgency", "agency_code agency_name", "agency"),
    _content("DimRecipient", "recipient_name_raw recipient_uei", "rec"),
    _content("DimNAICS", "naics_code naics_description naics_key", "nd"),
    _content("DimBusinessSize", "business_size business_size_code business_size_key", "bs"),
    _content("DimCountryOfOrigin", "country_of_origin country_of_origin_code country_of_origin_key", "odp"),
    _content("FactContract", "award_unique_key business_size_key country_of_origin_key naics_key transaction_unique_key",
             "fc")])


ORACLE["publish_versioned"] = f"""
with t as ({txn(True, True)}),
{GOLD_CONTRACTS},
now as (select distinct 'DimAgency' as table_name, agency_code as code, agency_name as name from ({AGENCY})
        union all select distinct 'DimRecipient', recipient_uei, recipient_name_raw from t
        where recipient_uei is not null and recipient_name_raw is not null),
old as (select 'DimAgency' as table_name, awarding_agency_code as code, awarding_agency_name as name, action_date from t
        union all select 'DimAgency', funding_agency_code, funding_agency_name, action_date from t
        union all select 'DimRecipient', recipient_uei, recipient_name_raw, action_date from t)
select table_name, code, name, cast(exists (select 1 from old where old.table_name = now.table_name and old.code = now.code
         and old.name = now.name and old.action_date < date '1997-01-01') as bigint) as in_version_before from now
union all select 'FactContract', transaction_unique_key, award_unique_key, 0 from fc"""

ORACLE["outer_merge_hot"] = """
with c as (select c_nationkey as nation, cast(floor(c_acctbal / 1000) as integer) as thousand, c_custkey from customer),
s as (select s_nationkey as nation, cast(floor(s_acctbal / 1000) as integer) as thousand, s_suppkey from supplier)
select nation, thousand, c_custkey, s_suppkey from c full outer join s using (nation, thousand)"""

ORACLE["names_as_of"] = f"""
with t as ({txn(True)}),
seen as (select recipient_uei, last_modified_date as d,
           max(recipient_name_raw || case when (year(last_modified_date) + cast(recipient_uei as bigint)) % 3 = 0 then ' LLC' else '' end) as name
         from t group by recipient_uei, last_modified_date),
steps as (select *, lag(name) over (partition by recipient_uei order by d) as prior from seen),
dim as (select recipient_uei, name, d as valid_from, lead(d) over (partition by recipient_uei order by d) as valid_to
        from steps where prior is null or prior <> name)
select t.transaction_unique_key, t.recipient_uei, t.action_date, dim.name as recipient_name, dim.valid_from, dim.valid_to
from t left join dim on t.recipient_uei = dim.recipient_uei and t.action_date >= dim.valid_from
     and (dim.valid_to is null or t.action_date < dim.valid_to)"""

ORACLE["year_layers"] = """
select cast(year(o_orderdate) as bigint) as fy, count(*) as n_orders, count(distinct o_orderkey) as n_keys,
       cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
from orders group by all"""

#: Published education columns in the order of the extract.
_EDUCATION = ["fips_code", "less_than_hs_17_21", "hs_only_17_21", "some_college_17_21", "bach_or_higher_17_21",
              "perc_less_than_hs_17_21", "perc_hs_only_17_21", "perc_some_college_17_21", "perc_bach_or_higher_17_21"]


def _education(i: int, name: str) -> str:
    if name == "fips_code":
        return "case when c_custkey < 100000 then printf('%05d', c_custkey) else cast(c_custkey as varchar) end as fips_code"
    if name.startswith("perc_"):
        return f"case when c_custkey % 7 <> {i % 7} then cast(c_nationkey as double) * 0.5 + {i} end as {name}"
    return f"case when c_custkey % 5 <> {i % 5} then cast(c_custkey * {1000 * (i + 1)} as bigint) end as {name}"


ORACLE["education_job"] = "select " + ", ".join(_education(i, n) for i, n in enumerate(_EDUCATION)) + " from customer"

ORACLE["unemployment_job"] = "select cast(c_custkey as varchar) as fips_code, " + ", ".join(
    f"case when c_custkey % 9 <> 0 then cast(c_nationkey as double) * 0.25 + {i} end as unemployment_rate_{y}"
    for i, y in enumerate((2019, 2020, 2021, 2022))) + """,
       cast(c_custkey * 10 as double) as median_household_income_2021
from customer where c_nationkey <> 3"""


def oracle_sql() -> dict:
    return dict(ORACLE)
