"""Pieces of checking SQL."""

from __future__ import annotations

# The characters with the Unicode White_Space property, for SQL trim().
WHITE_SPACE_CODES = (
    9, 10, 11, 12, 13, 32, 133, 160, 5760, 8192, 8193, 8194, 8195, 8196, 8197, 8198, 8199,
    8200, 8201, 8202, 8232, 8233, 8239, 8287, 12288,
)


def trimmed(column: str) -> str:
    characters = " || ".join(f"chr({code})" for code in WHITE_SPACE_CODES)
    return f"trim({column}, {characters})"


def utc(column: str) -> str:
    """RFC 3339 text of a timestamp."""
    return (
        f"(regexp_replace(strftime({column}, '%Y-%m-%dT%H:%M:%S.%f'), '\\.?0+$', '') || 'Z')"
    )


def number(column: str) -> str:
    """A double of moderate size as a JSON number: without a fraction where it is whole."""
    return (
        f"(CASE WHEN {column} = trunc({column}) AND abs({column}) < 1e15 "
        f"THEN to_json(cast({column} AS bigint)) ELSE to_json({column}) END)"
    )


def number_text(column: str) -> str:
    """Canonical JSON text of any finite double, from its shortest digits."""
    text = f"cast({column} AS varchar)"
    mantissa, power = f"split_part({text}, 'e', 1)", f"cast(split_part({text}, 'e', 2) AS integer)"
    digits = f"replace(replace({mantissa}, '.', ''), '-', '')"
    sign = f"(CASE WHEN {column} < 0 THEN '-' ELSE '' END)"
    return f"""(CASE WHEN NOT contains({text}, 'e') THEN regexp_replace({text}, '\\.0$', '')
        WHEN {power} >= 21 OR {power} < -6 THEN
            regexp_replace({mantissa}, '\\.0$', '') || 'e' || (CASE WHEN {power} < 0 THEN '-' ELSE '+' END)
            || abs({power})
        WHEN {power} < 0 THEN {sign} || '0.' || repeat('0', -{power} - 1) || rtrim({digits}, '0')
        WHEN length({digits}) <= {power} + 1 THEN
            {sign} || {digits} || repeat('0', {power} + 1 - length({digits}))
        ELSE {sign} || {digits}[1:{power} + 1] || '.' || {digits}[{power} + 2:] END)"""


def json(fields: dict[str, str]) -> str:
    """Canonical JSON of named SQL expressions."""
    packed = ", ".join(f'"{name}" := {fields[name]}' for name in sorted(fields))
    return f"cast(to_json(struct_pack({packed})) AS varchar)"


def body(fields: dict[str, str]) -> str:
    """JSON of named SQL expressions in the given order."""
    packed = ", ".join(f'"{name}" := {value}' for name, value in fields.items())
    return f"cast(to_json(struct_pack({packed})) AS varchar)"


def hash_key(payload: str, digits: int = 16) -> str:
    text = payload
    escapes = (
        ("&", "\\u0026"), ("<", "\\u003c"), (">", "\\u003e"),
    )
    for character, escape in escapes:
        text = f"replace({text}, '{character}', '{escape}')"
    for code in (8232, 8233):
        text = f"replace({text}, chr({code}), '\\u{code:04x}')"
    return f"substr(sha256({text}), 1, {digits})"


ORDERS = {
    "o_orderkey": "o_orderkey",
    "o_custkey": "o_custkey",
    "o_orderstatus": "o_orderstatus",
    "o_totalprice": number("o_totalprice"),
    "o_orderdate": utc("o_orderdate"),
    "o_orderpriority": "o_orderpriority",
}
EVENTS = {
    "event_id": "event_id",
    "ts": utc("ts"),
    "user_id": "user_id",
    "event_type": "event_type",
    "value": number("value"),
    "props": "props",
}
CUSTOMER = {
    name: name for name in ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
} | {"c_acctbal": number("c_acctbal")}
PAGES = {name: name for name in ("page_id", "url", "html")}
DOCUMENTS = {name: name for name in ("doc_id", "text", "lang", "source", "n_chars")}
CONVERSATIONS = {name: name for name in ("conv_id", "turn", "role", "text")}
LINEITEM = {
    name: name
    for name in (
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus",
    )
} | {"l_shipdate": utc("l_shipdate")} | {
    name: number(name) for name in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
}
