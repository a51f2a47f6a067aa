"""Data model: table schemas, defaults, the flag vocabulary and the bank-accounts contract.

Everything here is plain data.  The two metadata tables describe how a file is
parsed (``file_configuration``) and what its columns must look like
(``semantic_layer``); the log tables hold one verdict per judged file.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace
from typing import Any, Iterable, Mapping

from pyspark.sql import types as T

FILE_CONFIGURATION = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("file_format", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("has_header", T.BooleanType()),
        T.StructField("delimiter", T.StringType()),
        T.StructField("quote_char", T.StringType()),
        T.StructField("escape_char", T.StringType()),
        T.StructField("date_format", T.StringType()),
        T.StructField("timestamp_format", T.StringType()),
        T.StructField("partition_columns", T.StringType()),
    ]
)

SEMANTIC_LAYER = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("field_position", T.IntegerType()),
        T.StructField("field_name", T.StringType()),
        T.StructField("field_description", T.StringType()),
        T.StructField("pk", T.BooleanType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("length", T.StringType()),
        T.StructField("nullable", T.BooleanType()),
        T.StructField("decimal_symbol", T.StringType()),
        # null = the contract applies to every profile without its own rows
        T.StructField("file_config_id", T.IntegerType()),
    ]
)

VERDICT_LOG = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("file_config_id", T.IntegerType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("field_name", T.StringType()),
        T.StructField("environment", T.StringType()),
        T.StructField("validation_flag", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("logged_at", T.TimestampType()),
    ]
)

NEGATIVE_LOG = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("trigger_id", T.LongType())]
    + [f for f in VERDICT_LOG.fields if f.name != "id"]
)

# Column defaults of the two metadata tables.
PROFILE_DEFAULTS: dict[str, Any] = {
    "has_header": True,
    "delimiter": ",",
    "quote_char": '"',
    "escape_char": "\\",
    "date_format": "yyyy-MM-dd",
    "timestamp_format": "yyyy-MM-dd HH:mm:ss",
    "partition_columns": None,
}
CONTRACT_DEFAULTS: dict[str, Any] = {"pk": False, "nullable": True, "decimal_symbol": ","}

# Flags of the verdict log, (flag, phase, meaning).
FLAGS: list[tuple[str, str, str]] = [
    ("2", "final", "all phases passed"),
    ("30", "read", "read error"),
    ("32", "structural", "delimiter mismatch"),
    ("33", "structural", "header mismatch"),
    ("34", "structural", "column count per row mismatch"),
    ("35", "typing", "invalid type"),
    ("36", "typing", "unexpected null"),
    ("37", "typing", "length exceeded"),
    ("38", "typing", "invalid text format"),
    ("39", "key", "duplicate primary key"),
    ("40", "functional", "invalid format (account_number)"),
    ("41", "functional", "out of range (credit_score)"),
    ("42", "functional", "out of range (risk_score)"),
    ("43", "functional", "under age (date_of_birth)"),
    ("44", "functional", "negative balance while Active"),
    ("45", "functional", "non-zero balance while Closed"),
    ("46", "functional", "interest on a Checking account"),
    ("47", "functional", "invalid overdraft"),
    ("48", "functional", "too few transactions on a joint account"),
    ("49", "functional", "average amount without transactions"),
    ("99", "pre", "no configuration for the file"),
    ("1.13", "structural", "structural phase passed"),
    ("1.21", "typing", "typing phase passed"),
    ("1.31", "key", "key phase passed"),
    ("1.41", "functional", "functional phase passed"),
]
PHASES = ["structural", "typing", "key", "functional"]
PHASE_PASSED = {"structural": "1.13", "typing": "1.21", "key": "1.31", "functional": "1.41"}
PASSED = "2"

# Messages written to the log.
MSG_DELIMITER = "Delimiter mismatch"
MSG_HEADER = "Header mismatch"
MSG_COLUMN_COUNT = "Column count per row mismatch"
MSG_TYPE = "Tipo inválido"
MSG_NULL = "Nulo indebido"
MSG_LENGTH = "Longitud excedida"
MSG_TEXT = "Formato texto inválido"
MSG_DUPLICATE = "Duplicado PK"
MSG_UNCONFIGURED = "Sin configuración de fichero"


@dataclass(frozen=True)
class Profile:
    """How files of one logical name are parsed."""

    id: int = 0
    file_name: str = ""
    file_format: str = "csv"
    path: str = ""
    has_header: bool = True
    delimiter: str = ","
    quote_char: str | None = '"'
    escape_char: str | None = "\\"
    date_format: str | None = "yyyy-MM-dd"
    timestamp_format: str | None = "yyyy-MM-dd HH:mm:ss"
    partition_columns: str | None = None

    @classmethod
    def of(cls, row: Mapping[str, Any]) -> "Profile":
        return cls(**{f.name: row[f.name] for f in fields(cls)})

    def parse_key(self) -> "Profile":
        """The profile without its identity: files that agree on it can share one scan."""
        return replace(self, id=0, file_name="", path="", file_format="", partition_columns=None)


@dataclass(frozen=True)
class Field:
    """One column of a contract."""

    field_position: int
    field_name: str
    data_type: str
    length: str | None = None
    pk: bool = False
    nullable: bool = True
    decimal_symbol: str = ","

    @classmethod
    def of(cls, row: Mapping[str, Any]) -> "Field":
        return cls(**{f.name: row[f.name] for f in fields(cls)})


def contract_from_rows(rows: Iterable[Mapping[str, Any]]) -> list[Field]:
    return sorted((Field.of(r) for r in rows), key=lambda f: f.field_position)


def check_contract(contract: list[Field]) -> list[Field]:
    """Reject a contract no file could be judged by, before any data is read."""
    problems = []
    if not contract:
        problems.append("the contract has no fields")
    for what, values in (
        ("field_position", [f.field_position for f in contract]),
        ("field_name", [f.field_name for f in contract]),
    ):
        repeated = sorted({v for v in values if values.count(v) > 1})
        if repeated:
            problems.append(f"{what} repeated: {repeated}")
    for f in contract:
        if f.data_type.lower().startswith("decimal") and precision_scale(f.length) is None:
            problems.append(f"{f.field_name}: decimal needs length 'precision,scale', got {f.length!r}")
    if problems:
        raise ValueError("invalid contract: " + "; ".join(problems))
    return contract


def precision_scale(length: str | None) -> tuple[int, int] | None:
    parts = [p.strip() for p in (length or "").split(",")]
    if len(parts) != 2 or not all(p.isdigit() for p in parts):
        return None
    p, s = int(parts[0]), int(parts[1])
    return (p, s) if 1 <= p <= 38 and s <= p else None


# The bank-accounts contract, 30 columns, none nullable,
# (field_name, data_type, length).  account_number is the key.
_BANK_ACCOUNTS = [
    ("account_number", "CHAR", "10"),
    ("first_name", "VARCHAR", "50"),
    ("last_name", "VARCHAR", "50"),
    ("date_of_birth", "DATE", None),
    ("gender", "VARCHAR", "6"),
    ("email", "VARCHAR", "100"),
    ("phone", "VARCHAR", "13"),
    ("address", "VARCHAR", "100"),
    ("city", "VARCHAR", "50"),
    ("state", "VARCHAR", "50"),
    ("postal_code", "CHAR", "5"),
    ("country", "VARCHAR", "50"),
    ("account_type", "VARCHAR", "10"),
    ("currency", "CHAR", "3"),
    ("balance", "DECIMAL", "12,2"),
    ("created_date", "DATE", None),
    ("last_login", "TIMESTAMP", None),
    ("last_transaction_date", "TIMESTAMP", None),
    ("status", "VARCHAR", "10"),
    ("kyc_status", "VARCHAR", "8"),
    ("interest_rate", "DECIMAL", "4,2"),
    ("overdraft_limit", "DECIMAL", "8,2"),
    ("credit_score", "INT", None),
    ("risk_score", "DECIMAL", "5,2"),
    ("account_manager_id", "CHAR", "6"),
    ("branch", "VARCHAR", "5"),
    ("branch_city", "VARCHAR", "50"),
    ("is_joint_account", "VARCHAR", "3"),
    ("num_transactions", "INT", None),
    ("avg_transaction_amount", "DECIMAL", "8,2"),
]
BANK_ACCOUNTS: list[Field] = [
    Field(i, name, data_type, length, pk=name == "account_number", nullable=False)
    for i, (name, data_type, length) in enumerate(_BANK_ACCOUNTS, start=1)
]


@dataclass(frozen=True)
class BusinessRule:
    """A row-level rule: ``violation`` is SQL over the contract's column names; null is no violation."""

    flag: str
    field: str
    message: str
    violation: str


# The ten rules of the bank-accounts file.  ``:as_of`` is the judging date.
BANK_RULES: list[BusinessRule] = [
    BusinessRule("40", "account_number", "Formato inválido", "NOT account_number RLIKE '^[A-Za-z0-9]{10}$'"),
    BusinessRule("41", "credit_score", "Fuera de rango", "credit_score NOT BETWEEN 300 AND 850"),
    BusinessRule("42", "risk_score", "Fuera de rango", "risk_score NOT BETWEEN 0 AND 100"),
    BusinessRule("43", "date_of_birth", "Menor de edad", "months_between(:as_of, date_of_birth) < 216"),
    BusinessRule("44", "balance", "Negativo en Active", "status = 'Active' AND balance < 0"),
    BusinessRule("45", "balance", "No cero en Closed", "status = 'Closed' AND balance <> 0"),
    BusinessRule("46", "interest_rate", "Interest ≠0", "account_type = 'Checking' AND interest_rate <> 0"),
    BusinessRule(
        "47", "overdraft_limit", "Overdraft inválido",
        "overdraft_limit < 0 OR (overdraft_limit > 0 AND status <> 'Active')",
    ),
    BusinessRule("48", "num_transactions", "Pocas tx en joint", "is_joint_account = 'Yes' AND num_transactions < 2"),
    BusinessRule(
        "49", "avg_transaction_amount", "Avg tx ≠0 con 0 tx",
        "num_transactions = 0 AND avg_transaction_amount <> 0",
    ),
]
