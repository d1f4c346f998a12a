"""Declared schemas of the bank tables and header names of the raw files."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


S, I, D = T.StringType(), T.IntegerType(), T.DoubleType()

KYC = _struct(cust_id=S, Name=S, Gender=S, Occupation=S, Age=I, Tenure=I, label=I)
KYC_OPEN_SANCTIONS = _struct(cust_id=S, Name=S, Gender=S, Occupation=S, Age=I, Tenure=I, label=I, OpenSanc_query=I)
CASH = _struct(cash_trxn_id=S, cust_id=S, amount=D, type=S)
EMT = _struct(
    emt_trxn_id=S, id_sender=S, id_receiver=S, name_sender=S, name_receiver=S, emt_message=S, emt_value=D
)
WIRE = _struct(
    wire_trxn_id=S,
    id_sender=S,
    id_receiver=S,
    name_sender=S,
    name_receiver=S,
    wire_value=D,
    country_sender=S,
    country_receiver=S,
)
SUSPECTS = _struct(id=S, Name=S, emt=I, wire=I, label=I, Buyer=I, Seller=I, weight=D)
ARTICLES = _struct(Link=S, Title=S, Text=S)

TABLES = {
    "kyc": KYC,
    "kyc_with_open_sanctions": KYC_OPEN_SANCTIONS,
    "cash_trxns": CASH,
    "emt_trxns": EMT,
    "wire_trxns": WIRE,
}

KEYS = {
    "kyc": "cust_id",
    "kyc_with_open_sanctions": "cust_id",
    "cash_trxns": "cash_trxn_id",
    "emt_trxns": "emt_trxn_id",
    "wire_trxns": "wire_trxn_id",
}

# Foreign keys, all of them to kyc.cust_id: table -> columns.
FOREIGN_KEYS = {"cash_trxns": ("cust_id",), "emt_trxns": ("id_sender", "id_receiver"), "wire_trxns": ("id_sender", "id_receiver")}

# Header of the raw files -> column of the declared table.
RAW_HEADERS = {
    "kyc": {},
    "kyc_with_open_sanctions": {},
    "cash_trxns": {"trxn_id": "cash_trxn_id"},
    "emt_trxns": {
        "trxn_id": "emt_trxn_id",
        "id sender": "id_sender",
        "id receiver": "id_receiver",
        "name sender": "name_sender",
        "name receiver": "name_receiver",
        "emt message": "emt_message",
        "emt value": "emt_value",
    },
    "wire_trxns": {
        "trxn_id": "wire_trxn_id",
        "id sender": "id_sender",
        "id receiver": "id_receiver",
        "name sender": "name_sender",
        "name receiver": "name_receiver",
        "wire value": "wire_value",
        "country sender": "country_sender",
        "country receiver": "country_receiver",
    },
}
