"""Builders for the longer pieces of oracle SQL."""

from __future__ import annotations

from grovekit.functions import prompts
from workloads.inputs import CLASSES

W = r"\p{L}\p{N}_"
S = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
END = r"\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}"


def last_token(text: str, alternatives: str) -> str:
    pattern = rf"(?is)^(?:.*[^{W}])?({alternatives})(?:[^{W}]|$)"
    return f"nullif(regexp_extract({text}, '{pattern}', 1), '')"


def extract_bool(text: str) -> str:
    def canonical(alternatives: str, positive: str) -> str:
        token = last_token(text, alternatives)
        return (
            f"(CASE WHEN {token} IS NULL THEN NULL "
            f"WHEN lower({token}) = '{positive}' THEN 'True' ELSE 'False' END)"
        )

    parts = [canonical("true|false", "true"), canonical("[01]", "1"), canonical("yes|no", "yes")]
    return f"coalesce({', '.join(parts)})"


def extract_count(text: str) -> str:
    names = ["zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten"]
    word = f"lower({last_token(text, '|'.join(names))})"
    cases = " ".join(f"WHEN '{n}' THEN '{i}'" for i, n in enumerate(names))
    digits = f"regexp_replace({last_token(text, '[0-9]+')}, '^0+([0-9])', '\\1')"
    return f"coalesce({digits}, CASE {word} {cases} END)"


def extract(text: str, kind: str) -> str:
    return (
        f"(CASE {kind} WHEN 'count' THEN {extract_count(text)} "
        f"WHEN 'output' THEN {extract_bool(text)} END)"
    )


def strip_artifacts(text: str, question: str | None = None) -> str:
    """Two passes, because neighbouring assignments share a separator."""
    out = text
    if question:
        out = (
            f"(CASE WHEN strpos({text}, {question}) > 0 "
            f"THEN substr({text}, strpos({text}, {question}) + length({question})) ELSE {text} END)"
        )
    pattern = rf"(^|[^{W}])x\p{{Nd}}+{S}*={S}*(?:true|false)([^{W}]|$)"
    once = f"regexp_replace({out}, '{pattern}', '\\1 \\2', 'gi')"
    return f"regexp_replace({once}, '{pattern}', '\\1 \\2', 'gi')"


def clean_answer(source: str, text: str, out: str, question: str | None = None, default: str = "NULL") -> str:
    """A query over ``source`` (with kind) that adds the parsed answer."""
    marker = rf"(?is)^.*final{S}*answer{S}*[:\-–]?"
    first_line = f"regexp_extract(_tail, '^[^{END}]*', 0)"
    return f"""SELECT * EXCLUDE (_cleaned, _tail),
      coalesce({extract(first_line, 'kind')}, {extract('_tail', 'kind')},
        {extract('_cleaned', 'kind')}, {default}) AS {out}
    FROM (SELECT *, CASE WHEN regexp_matches(_cleaned, '{marker}')
        THEN regexp_replace(_cleaned, '{marker}', '') END AS _tail
      FROM (SELECT *, {strip_artifacts(text, question)} AS _cleaned FROM {source}))"""


def stand_in_value(user: str, salt: str | None = None) -> str:
    seed = user if salt is None else f"{user} || '|' || {salt}"
    h = f"md5({seed})"
    chunks = " + ".join(f"('0x' || substr({h}, {1 + 8 * i}, 8))::BIGINT" for i in range(4))
    return (
        f"(CASE WHEN contains({user}, 'How many') THEN CAST(({chunks}) % 5 AS VARCHAR) "
        f"WHEN ('0x' || substr({h}, 25, 8))::BIGINT % 2 = 1 THEN 'True' ELSE 'False' END)"
    )


def literal(text: str) -> str:
    """A SQL string; line breaks are written as chr(10)."""
    return " || chr(10) || ".join("'" + part.replace("'", "''") + "'" for part in text.split("\n"))


REASONING = literal(prompts.STAND_IN_REASONING)
STEPWISE = f"|| {literal(prompts.STEPWISE_SUFFIX)}"
REVIEW = literal(prompts.REVIEW_REQUEST)


def stand_in_text(user: str, salt: str | None = None) -> str:
    value = stand_in_value(user, salt)
    return (
        f"(CASE WHEN contains({user}, 'step-by-step') OR contains(lower({user}), 'corrected breakdown') "
        f"THEN {REASONING} || {value} ELSE {value} END)"
    )


def words(text: str) -> str:
    return f"len(list_filter(regexp_split_to_array({text}, '{S}+'), lambda w: w <> ''))"


def score(preds: str, refs: str) -> str:
    """Rows of the exact-match score of two CTEs, total included."""
    return f"""SELECT kind, CAST(count(p."index") AS BIGINT) AS n,
      CAST(count(*) FILTER (p."index" IS NOT NULL AND coalesce(p.answer, 'None') = r.answer) AS BIGINT) AS correct,
      round(CASE WHEN count(p."index") = 0 THEN 0.0 ELSE 100.0 *
        count(*) FILTER (p."index" IS NOT NULL AND coalesce(p.answer, 'None') = r.answer)
        / count(p."index") END, 6)::DOUBLE AS accuracy,
      round(sum(p.elapsed_s) / nullif(count(p.elapsed_s), 0), 6) AS avg_s,
      CAST(count(*) FILTER (p."index" IS NULL) AS BIGINT) AS missing
    FROM (SELECT "index", kind, answer FROM {refs}) r
    LEFT JOIN (SELECT "index", answer, elapsed_s FROM {preds}) p USING ("index")
    GROUP BY ROLLUP (kind)"""


def impurity(counts: list[str], method: str) -> str:
    n = "(" + " + ".join(counts) + ")"
    if method == "gini":
        return "(1.0 - (" + " + ".join(f"({c}::DOUBLE / {n}) * ({c}::DOUBLE / {n})" for c in counts) + "))"
    return (
        "("
        + " + ".join(
            f"(CASE WHEN {c} > 0 THEN -({c}::DOUBLE / {n}) * log2({c}::DOUBLE / {n}) ELSE 0.0 END)"
            for c in counts
        )
        + ")"
    )


def gain(left: list[str], total: list[str], method: str) -> str:
    right = [f"({t} - {c})" for c, t in zip(left, total)]
    nu = f"(({' + '.join(left)})::DOUBLE / ({' + '.join(total)}))"
    return (
        f"({impurity(total, method)} - ({nu} * {impurity(left, method)} "
        f"+ (1.0 - {nu}) * {impurity(right, method)}))"
    )


def gains(source: str, keys: list[str], method: str, midpoint: bool = True, weight: str = "1") -> str:
    """Query: every candidate threshold of ``source`` (keys, value, label) with its gain."""
    by = ", ".join(keys)
    k = range(len(CLASSES))
    counts = ", ".join(f"sum(CASE WHEN label = {c} THEN {weight} ELSE 0 END)::BIGINT AS c{c}" for c in CLASSES)
    run = f"OVER (PARTITION BY {by} ORDER BY value ROWS UNBOUNDED PRECEDING)"
    lefts = ", ".join(f"(sum(c{i}) {run})::BIGINT AS l{i}" for i in k)
    alls = ", ".join(f"(sum(c{i}) OVER (PARTITION BY {by}))::BIGINT AS n{i}" for i in k)
    th = "(value + nxt) / 2.0" if midpoint else "value"
    formula = gain([f"l{i}" for i in k], [f"n{i}" for i in k], method)
    kept = ", ".join(f"l{i}, n{i}" for i in k)
    return f"""SELECT {by}, {th} AS th, {formula} AS gain, {kept} FROM (
      SELECT {by}, value, lead(value) OVER (PARTITION BY {by} ORDER BY value) AS nxt, {lefts}, {alls}
      FROM (SELECT {by}, value, {counts} FROM {source} GROUP BY {by}, value)) WHERE nxt IS NOT NULL"""


def forest_ctes(depth: int, method: str, midpoint: bool = True) -> str:
    """CTEs that grow trees from ``li``, ``bag`` (tree_id, row_key, weight), ``sub`` (tree_id, feature).

    Ends with ``nodes`` and, per level, ``r{d}`` with every row's node.
    """
    k = range(len(CLASSES))
    value = "CASE feature WHEN 0 THEN f0 WHEN 1 THEN f1 WHEN 2 THEN f2 ELSE f3 END"
    out = [
        "r0 AS (SELECT tree_id, 1::BIGINT AS node_id, weight, li.* FROM bag JOIN li USING (row_key))"
    ]
    for d in range(depth):
        out.append(
            f"""impure{d} AS (SELECT tree_id, node_id FROM r{d} GROUP BY ALL HAVING count(DISTINCT label) > 1),
v{d} AS (SELECT tree_id, node_id, feature, label, weight, {value} AS value
  FROM r{d} JOIN impure{d} USING (tree_id, node_id) JOIN sub USING (tree_id)),
g{d} AS ({gains(f'v{d}', ['tree_id', 'node_id', 'feature'], method, midpoint, 'weight')}),
b{d} AS (SELECT * FROM g{d} QUALIFY row_number() OVER (
  PARTITION BY tree_id, node_id ORDER BY round(gain, 12) DESC, feature, th) = 1),
r{d + 1} AS (SELECT r.* REPLACE (node_id * 2 + CASE WHEN {value} <= th THEN 0 ELSE 1 END AS node_id)
  FROM r{d} r JOIN (SELECT tree_id, node_id, feature, th FROM b{d}) USING (tree_id, node_id))"""
        )
    counts = ", ".join(f"sum(CASE WHEN label = {c} THEN weight ELSE 0 END)::BIGINT AS c{c}" for c in CLASSES)
    parts = []
    for d in range(depth + 1):
        join = f"LEFT JOIN b{d} USING (tree_id, node_id)" if d < depth else ""
        th, feature = ("th", "feature") if d < depth else ("NULL::DOUBLE", "NULL::INT")
        parts.append(
            f"SELECT tree_id, node_id, {feature} AS feature, {th} AS th, "
            + ", ".join(f"c{c}" for c in CLASSES)
            + f" FROM (SELECT tree_id, node_id, {counts} FROM r{d} GROUP BY ALL) {join}"
        )
    best = "CASE " + " ".join(
        "WHEN " + " AND ".join(f"c{i} >= c{j}" for j in k) + f" THEN {i}" for i in k
    ) + " END"
    out.append(
        f"""raw_nodes AS ({' UNION ALL '.join(parts)}),
nodes AS (SELECT tree_id, node_id, CASE WHEN th IS NULL THEN 'leaf' ELSE 'axis' END AS kind, feature, th,
  CASE WHEN th IS NULL THEN {best} END AS label, c0, c1, c2 FROM raw_nodes)"""
    )
    return ",\n".join(out)


def walk(source: str, depth: int, key: str = "row_key") -> str:
    """CTEs ``w0 … w{depth}`` and ``leafs``: rows of ``source`` (tree_id, key, f*) in ``nodes``."""
    out = [f"w0 AS (SELECT *, 1::BIGINT AS spot FROM {source})"]
    value = "CASE n.feature WHEN 0 THEN f0 WHEN 1 THEN f1 WHEN 2 THEN f2 ELSE f3 END"
    for d in range(depth):
        out.append(
            f"""w{d + 1} AS (SELECT w.* REPLACE (CASE WHEN n.th IS NULL THEN spot
  WHEN {value} <= n.th THEN 2 * spot ELSE 2 * spot + 1 END AS spot)
  FROM w{d} w JOIN nodes n ON n.tree_id = w.tree_id AND n.node_id = w.spot)"""
        )
    out.append(
        f"""leafs AS (SELECT w.{key}, w.tree_id, w.spot AS node_id, n.label AS predicted
  FROM w{depth} w JOIN nodes n ON n.tree_id = w.tree_id AND n.node_id = w.spot)"""
    )
    return ",\n".join(out)
