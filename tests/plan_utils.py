"""Helpers to inspect physical plan trees in tests."""

FACT_COLUMNS = ("o_orderkey", "event_id", "l_orderkey")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def ancestors(lines, idx):
    """Node text of the ancestors of tree line ``idx``, nearest first."""
    def depth(line):
        return next(i for i, ch in enumerate(line) if ch.isalnum() or ch == "*")
    chain, d = [], depth(lines[idx])
    for line in reversed(lines[:idx]):
        if line.strip() and depth(line) < d:
            chain.append(line.lstrip(" :+-").strip())
            d = depth(line)
    return chain


def fact_rows_combined_before_exchange(df) -> bool:
    """Every fact-table scan passes a partial aggregate before its first exchange."""
    lines = plan(df).splitlines()
    scans = [i for i, line in enumerate(lines)
             if "FileScan" in line and any(c in line for c in FACT_COLUMNS)]
    for i in scans:
        chain = ancestors(lines, i)
        exchanges = [k for k, node in enumerate(chain) if node.startswith("Exchange")]
        if exchanges and not any("partial_" in node for node in chain[:exchanges[0]]):
            return False
    return bool(scans)
