"""SQL of the derived bank tables, for the side-by-side check."""

import re

KYC = """
select 'CUST' || lpad(cast(c_custkey as varchar), 8, '0') as cust_id,
  case when c_custkey % 7 = 0 then 'DR.' when c_custkey % 11 = 0 then 'MRS. ' else '' end
    || 'NAME ' || cast(c_custkey % 1000 as varchar) as Name,
  case when c_custkey % 20 = 0 then 'other' when c_custkey % 2 = 0 then 'male' else 'female' end as Gender,
  c_mktsegment || ' ' || cast(c_nationkey % 10 as varchar) as Occupation,
  cast(case when c_custkey % 97 = 0 then null else 18 + (c_custkey * 7) % 75 end as integer) as Age,
  cast((c_custkey * 5) % 49 as integer) as Tenure,
  case when c_acctbal < 0 then 1 else 0 end as label,
  case when c_custkey % 23 = 0 then 1 else 0 end as OpenSanc_query
from customer"""

TRANSFERS = """
select *, (k * 7919 + 13) % (n + cast(floor(n / 10.0) as bigint)) as r from (
  select o_orderkey as k, o_orderstatus as status, o_totalprice as value, o_orderpriority as priority,
    o_custkey as s, (select count(*) from customer) as n
  from orders) t"""


def _party(key: str) -> str:
    return (
        f"case when {key} >= n then 'EXTERNAL' || lpad(cast({key} as varchar), 6, '0') "
        f"else 'CUST' || lpad(cast({key} as varchar), 8, '0') end"
    )


def _country(key: str) -> str:
    return f"nullif(substring('AUCACNGEINMXRUSAUKUSZZ', cast(2 * ({key} % 12) + 1 as int), 2), '')"


WIRE = f"""
select 'W' || cast(k as varchar) as wire_trxn_id, {_party('s')} as id_sender, {_party('r')} as id_receiver,
  'NAME ' || cast(s % 1000 as varchar) as name_sender, 'NAME ' || cast(r % 1000 as varchar) as name_receiver,
  value as wire_value, {_country('s')} as country_sender, {_country('r')} as country_receiver
from transfers where status = 'F'"""

EMT = f"""
select 'E' || cast(k as varchar) as emt_trxn_id, {_party('s')} as id_sender, {_party('r')} as id_receiver,
  'NAME ' || cast(s % 1000 as varchar) as name_sender, 'NAME ' || cast(r % 1000 as varchar) as name_receiver,
  case when k % 5 = 0 then null else p_name || '! ' || upper(p_type) end as emt_message, value as emt_value
from transfers join part on p_partkey = k % (select count(*) from part) where status = 'O'"""

CASH = f"""
select 'C' || cast(k as varchar) as cash_trxn_id, {_party('s')} as cust_id, value as amount,
  case when priority < '3' then 'deposit' else 'withdrawal' end as type
from transfers where status = 'P'"""

ARTICLES = """
select 'https://news.example/' || cast(doc_id as varchar) as Link, split_part(text, chr(10), 1) as Title, text as Text
from documents"""

LEGS = """
select id_sender as cust_id, id_receiver as other_id, 'wire' as ch, 'sent' as dir, wire_trxn_id as trxn_id,
  wire_value as amount, coalesce(country_sender <> country_receiver, false) as intl,
  country_sender as own_country, country_receiver as other_country, null as msg from wire
union all
select id_receiver, id_sender, 'wire', 'received', wire_trxn_id, wire_value,
  coalesce(country_sender <> country_receiver, false), country_receiver, country_sender, null from wire
union all
select id_sender, id_receiver, 'emt', 'sent', emt_trxn_id, emt_value, false, null, null, emt_message from emt
union all
select id_receiver, id_sender, 'emt', 'received', emt_trxn_id, emt_value, false, null, null, emt_message from emt
union all
select cust_id, null, 'cash', case type when 'deposit' then 'received' else 'sent' end, cash_trxn_id, amount,
  false, null, null, null from cash"""


def n(ch: str, dir: str, extra: str = "") -> str:
    return f"count(*) filter (where l.ch = '{ch}' and l.dir = '{dir}'{extra})"


def amount(ch: str, dir: str) -> str:
    return f"coalesce(sum(l.amount) filter (where l.ch = '{ch}' and l.dir = '{dir}'), 0.0)"


BASIC = f"""
  {n('wire', 'sent')} as no_wire_trxns_sent, {amount('wire', 'sent')} as wire_total_amnt_sent,
  {n('wire', 'sent', ' and l.intl')} as no_international_wire_trxns_sent,
  {n('wire', 'received')} as no_wire_trxns_received, {amount('wire', 'received')} as wire_total_amnt_received,
  {n('wire', 'received', ' and l.intl')} as no_international_wire_trxns_received,
  {n('emt', 'sent')} as no_emt_trxns_sent, {amount('emt', 'sent')} as emt_total_amnt_sent,
  {n('emt', 'received')} as no_emt_trxns_received, {amount('emt', 'received')} as emt_total_amnt_received,
  {n('cash', 'received')} as no_cash_deposits, {amount('cash', 'received')} as total_cash_deposit,
  {n('cash', 'sent')} as no_cash_withdraws, {amount('cash', 'sent')} as total_cash_withdraw"""

TOTALS = """
  no_international_wire_trxns_sent + no_international_wire_trxns_received as total_international_trxns,
  no_wire_trxns_sent + no_wire_trxns_received as total_no_wire_trxns,
  no_emt_trxns_sent + no_emt_trxns_received as total_no_emt_trxns,
  no_cash_deposits + no_cash_withdraws as total_no_cash_trxns,
  wire_total_amnt_received - wire_total_amnt_sent as wire_trxn_balance,
  emt_total_amnt_received - emt_total_amnt_sent as emt_trxn_balance,
  total_cash_deposit - total_cash_withdraw as cash_balance"""

FEATURES = f"""
select *, {TOTALS} from (
  select k.Name, k.Gender, k.Occupation, k.Age, k.Tenure, k.cust_id, k.label, {BASIC}
  from kyc k left join legs l on l.cust_id = k.cust_id group by all) f"""

NETWORK = """
select wire_trxn_id as trxn_id, id_sender, id_receiver, name_sender, name_receiver, wire_value as value, 1 as transfer_type from wire
union all select emt_trxn_id, id_sender, id_receiver, name_sender, name_receiver, emt_value, 0 from emt"""

ALL_NAMES = """
select cust_id as customer_id, Name as name from kyc
union select id_sender, name_sender from network union select id_receiver, name_receiver from network"""

EDGES = """
select id_sender as Source, id_receiver as Target, count(*) as counts, sum(value) as total_transaction_amount
from network group by all"""

WEIGHTS = """
select id_sender as id, sum(case when id_receiver in (select id from seeds) then value else 0 end) / sum(value) as weight
from network group by 1 having weight > 0"""

SUSPECTS = """
select id, min(Type) as Type from (
  select cust_id as id, case when cast(substr(cust_id, 5) as bigint) % 100 = 0 then 'seller' else 'buyer' end as Type
  from kyc where cast(substr(cust_id, 5) as bigint) % 50 = 0
  union all select cust_id, 'buyer' from kyc where cast(substr(cust_id, 5) as bigint) % 200 = 0) group by id"""

VIEWS = {
    "kyc": KYC,
    "transfers": TRANSFERS,
    "wire": WIRE,
    "emt": EMT,
    "cash": CASH,
    "seeds": "select cust_id as id from kyc where cast(substr(cust_id, 5) as bigint) % 50 = 0",
    "risk_ids": "select cust_id as id from kyc where label = 1",
    "articles": ARTICLES,
    "legs": LEGS,
    "features": FEATURES,
    "network": NETWORK,
    "all_names": ALL_NAMES,
    "edges": EDGES,
    "weights": WEIGHTS,
    "suspects": SUSPECTS,
}


def with_views(sql: str, *extra: tuple[str, str]) -> str:
    """Put the derived tables a query uses before it."""
    bodies = dict([*VIEWS.items(), *extra])
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in bodies:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(bodies[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    return "with " + ",\n".join(f"{name} as ({bodies[name]})" for name in needed) + "\n" + sql
