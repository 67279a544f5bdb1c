"""Data contracts: YAML -> Spark schema + row predicates.

Driver-side configuration only; the rules compile to ``Column`` predicates that
run on the executors inside the split operator.
"""

from __future__ import annotations

import importlib.resources
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .operators.split import REASON, Rule, passes, reason_column

BUNDLED = {
    "producer": "ledger_producer_v1.yaml",
    "consumer": "risk_consumer_v2.yaml",
    "product": "adjudication_product_v2.yaml",
}


@dataclass
class Contract:
    raw: dict[str, Any]
    source: str = "<dict>"
    columns: list[dict[str, Any]] = field(init=False)

    def __post_init__(self):
        cols = self.raw.get("required_schema", self.raw.get("schema", []))
        if isinstance(cols, dict):  # "name: type" mapping form
            cols = [{"name": k, "type": v} for k, v in cols.items()]
        self.columns = list(cols)

    @property
    def names(self) -> list[str]:
        return [c["name"] for c in self.columns]

    def column(self, name: str) -> dict[str, Any]:
        for c in self.columns:
            if c["name"] == name:
                return c
        raise KeyError(f"{name} not in contract {self.source}")

    def allowed_values(self, name: str) -> list[Any] | None:
        """Allowed values looked up by column name (not list position)."""
        return self.column(name).get("allowed_values")

    def masking_targets(self) -> list[str]:
        """SHA-256 targets; the policy may be a mapping or a one-element list of one."""
        policy = (self.raw.get("data_security") or {}).get("masking_policy") or {}
        if isinstance(policy, list):
            policy = policy[0] if policy and isinstance(policy[0], dict) else {}
        return list(policy.get("apply_sha256", []) or [])

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c["name"], _spark_type(c.get("type", "string")), True)
                             for c in self.columns])

    def rules(self, columns: list[str] | None = None, prefix: str = "CONTRACT_VIOLATION") -> list[Rule]:
        """compile declared constraints to rules, in contract order.

        Supported: ``is_not_null``, ``length`` (maximum characters for strings,
        bytes for binary), ``range: [lo, hi]`` (inclusive, NaN fails) and
        ``allowed_values``. Columns absent from ``columns`` are skipped (F12).
        """
        out: list[Rule] = []
        for c in self.columns:
            name = c["name"]
            if columns is not None and name not in columns:
                continue
            ref = F.col(name)
            for constraint in c.get("constraints", []) or []:
                for kind, arg in constraint.items():
                    if kind == "is_not_null" and arg:
                        out.append(Rule(f"{name}.not_null", f"{prefix}: {name} is null", ref.isNotNull()))
                    elif kind == "range":
                        lo, hi = arg
                        out.append(Rule(f"{name}.range", f"{prefix}: {name} outside [{lo}, {hi}]",
                                        in_range(ref, lo, hi)))
            if "length" in c and c.get("check_length", True) and c.get("type", "string") in ("string", "binary"):
                n = int(c["length"])
                out.append(Rule(f"{name}.length", f"{prefix}: {name} longer than {n}",
                                ref.isNull() | (F.length(ref) <= n)))
            if c.get("allowed_values") is not None:
                out.append(Rule(f"{name}.allowed", f"{prefix}: {name} not in allowed values",
                                ref.isNull() | in_enum(ref, c["allowed_values"])))
        return out


def in_range(c, lo, hi) -> Column:
    """inclusive range check; NaN fails (NaN sorts above every number in Spark)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.between(F.lit(lo), F.lit(hi)) & ~F.isnan(c.cast("double"))


def in_enum(c, values) -> Column:
    """F8: membership in an allowed set."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isin(list(values))


def required(columns: list[str], df: DataFrame | None = None) -> Column:
    """every field present, struct leaves included."""
    leaves: list[Column] = []
    for name in columns:
        leaves.append(F.col(name).isNotNull())
        if df is not None:
            dtype = df.schema[name].dataType
            if isinstance(dtype, T.StructType):
                leaves.extend(F.col(f"{name}.{f.name}").isNotNull() for f in dtype.fields)
    out = F.lit(True)
    for leaf in leaves:
        out = out & leaf
    return out


def existing(df: DataFrame, columns: list[str]) -> list[str]:
    """keep only the columns the frame has."""
    return [c for c in columns if c in df.columns]


def _spark_type(t: str) -> T.DataType:
    t = str(t).split("(")[0].strip()
    simple = {"string": T.StringType(), "double": T.DoubleType(), "float": T.DoubleType(),
              "binary": T.BinaryType(), "long": T.LongType(), "int": T.IntegerType(),
              "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType(),
              "boolean": T.BooleanType()}
    if t in simple:
        return simple[t]
    return T._parse_datatype_string(t)


def load_contract(source: str | dict | Contract) -> Contract:
    """A path on any file system of the session, a bundled name (producer / consumer / product), a dict or a Contract."""
    import yaml

    if isinstance(source, Contract):
        return source
    if isinstance(source, dict):
        return Contract(source)
    if source in BUNDLED:
        text = importlib.resources.files("ledgerflow.config").joinpath(BUNDLED[source]).read_text()
        return Contract(yaml.safe_load(text), source=BUNDLED[source])
    return Contract(yaml.safe_load(_contract_text(source)), source=source)


def _contract_text(path: str) -> str:
    """A contract file: through the session's file systems where there is a session (a path without a scheme belongs to
    its default one), else from the local disk."""
    from pyspark.sql import SparkSession

    from .sources.tables import read_text, require_path

    spark = SparkSession.getActiveSession()
    if spark is None:
        with open(path, encoding="utf-8") as fh:
            return fh.read()
    return read_text(spark, require_path(spark, path))


def conform(df: DataFrame, contract: str | dict | Contract, prefix: str = "CONTRACT_VIOLATION") -> tuple[DataFrame, DataFrame]:
    """F11 on a whole table: (rows that keep the contract, rejects).

    Valid rows have the contract's columns, in its order, with its types (``Contract.schema()``). A column that is absent
    is NULL. A value that does not convert breaks the rule ``<name> is not a <type>``, which stands before the column's
    constraints. Rejects keep their columns as they came, with the first broken rule's reason; columns that the contract
    does not name are theirs alone.
    """
    contract = load_contract(contract)
    names, rules = [f"__c{i}" for i in range(len(contract.columns))], []
    typed = df
    have = {c.lower(): c for c in df.columns}
    for name, field in zip(names, contract.schema()):
        raw = df[have[field.name.lower()]] if field.name.lower() in have else F.lit(None)
        same = field.name.lower() in have and df.schema[have[field.name.lower()]].dataType == field.dataType
        value = raw if same else raw.try_cast(field.dataType)
        typed = typed.withColumn(name, value)
        if not same and field.name.lower() in have:
            rules.append((field.name, Rule(f"{field.name}.type", f"{prefix}: {field.name} is not a {field.dataType.simpleString()}",
                                           raw.isNull() | F.col(name).isNotNull())))
    shadow = Contract({"schema": [{**c, "name": n} for c, n in zip(contract.columns, names)]})
    for own, c in zip(names, contract.columns):
        rules += [(c["name"], Rule(r.name, r.reason.replace(own, c["name"]), r.ok)) for r in shadow.rules([own], prefix)]
    order = {c["name"]: i for i, c in enumerate(contract.columns)}
    ordered = [r for _, r in sorted(rules, key=lambda x: order[x[0]])]
    ok = passes(ordered)
    valid = typed.where(ok).select(*[F.col(n).alias(c["name"]) for n, c in zip(names, contract.columns)])
    rejects = typed.where(~ok).withColumn(REASON, reason_column(ordered)).drop(*names)
    return valid, rejects
