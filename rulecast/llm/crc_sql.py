"""crc32 in DuckDB SQL, for the SQL counterparts of queries that use it."""

CRC_TABLE = """crc_table AS (
    SELECT list(v ORDER BY i) AS crc FROM (
        SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM range(256) AS r(i)) AS x
)"""


def crc32_sql(text: str) -> str:
    """The unsigned crc32 of a text's UTF-8 bytes; needs ``crc_table`` in the FROM clause."""
    code = f"list_transform(range(strlen({text})), lambda i: CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT))"
    step = "lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, {code}), {step}), 4294967295)"
