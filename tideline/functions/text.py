"""Printed output formats.

Fixed values: the text layouts the reference's jobs print, kept verbatim so
results compare equal. ``{name}`` marks a column.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (reference output layouts).
SENSOR_RECORD = "WaterSensor(id={id}, ts={ts}, vc={vc})"
WINDOW_HEADER = "key={key}的窗口[{start},{end})包含{count}条数据"
AGG_AND_PROCESS = "{key}:[{record}],"
PARITY_SUM = "key：{label}[{total}]"
LEVEL_JUMP = "lastVc:{last},vc:{vc}"
RUNNING_SUM = "key:{key},vcSum:{sum}"
HISTOGRAM_ENTRY = "vc={vc},count={count}"
THRESHOLD_ALERT = "{record},水位超过指定阈值：{threshold}!!!"
TOPN_ENTRY = "Top{rank}\nvc={vc}\ncount={count}\n窗口结束时间={end}\n"
RULE = "================================"
JOIN_ARROW_WINDOW = "---->"
JOIN_ARROW_INTERVAL = "--->"

_FIELD = re.compile(r"\{(\w+)\}")


def render(template: str, null_text: str | None = "null", **cols: Column) -> Column:
    """``concat`` of the template's literal parts and the given columns (cast
    to string; nulls print as ``null_text`` like Java string concatenation)."""
    parts, pos = [], 0
    for m in _FIELD.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        c = cols[m.group(1)].cast("string")
        parts.append(F.coalesce(c, F.lit(null_text)) if null_text is not None else c)
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


def sql_render(template: str, null_text: str | None = "null", **exprs: str) -> str:
    """The DuckDB twin of :func:`render` (for oracle SQL)."""
    parts, pos = [], 0
    for m in _FIELD.finditer(template):
        if m.start() > pos:
            parts.append(_sql_lit(template[pos:m.start()]))
        e = f"CAST({exprs[m.group(1)]} AS VARCHAR)"
        parts.append(f"coalesce({e}, {_sql_lit(null_text)})" if null_text is not None else e)
        pos = m.end()
    if pos < len(template):
        parts.append(_sql_lit(template[pos:]))
    return "concat(" + ", ".join(parts) + ")"


def _sql_lit(s: str) -> str:
    out, buf = [], ""
    for ch in s:
        if ch == "\n":
            if buf:
                out.append("'" + buf.replace("'", "''") + "'")
                buf = ""
            out.append("chr(10)")
        else:
            buf += ch
    if buf:
        out.append("'" + buf.replace("'", "''") + "'")
    return " || ".join(out) if out else "''"
