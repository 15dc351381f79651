"""CRC-32 as DuckDB SQL, which has no function for it: common table
expressions that the SQL of several operators starts with."""

# the 256 remainders, from the rule: eight steps of the reflected polynomial 0xEDB88320


def crc_table() -> str:
    """``crc_table(remainders)``: one row, a list of 256 numbers."""
    steps = "SELECT i AS byte, i::BIGINT AS x FROM range(256) r(i)"
    for _ in range(8):
        steps = f"SELECT byte, xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END) AS x FROM ({steps})"
    return f"crc_table AS MATERIALIZED (SELECT list(x ORDER BY byte) AS remainders FROM ({steps}))"


def crc_of(text: str) -> str:
    """crc32 of the UTF-8 bytes of the SQL text ``text``; ``remainders`` must be in scope."""
    digits = f"hex(encode({text}))"
    data = f"list_transform(range(0, length({digits}) // 2), lambda i: ('0x' || substr({digits}, 2 * i + 1, 2))::BIGINT)"
    fold = "lambda c, b: xor(remainders[(xor(c, b) & 255) + 1], c >> 8)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {data}), {fold}), 4294967295)"
