"""Bounded incremental window ``(start, job_start]`` of an extract.

Templates use the placeholders ``<IncrementalColumn>``,
``<IncrementalStartTime>`` and ``<JobStartTime>``, alone, in quotes, after a
type keyword (``TIMESTAMP '<JobStartTime>'``) or inside a longer quoted text; the
column may follow a table alias (``e.<IncrementalColumn>``) or stand in backticks.
A template is scanned into code, quoted texts, quoted names and comments, so that a
quote in a comment, or ``--`` in a text, means nothing; placeholders in comments
stay as they are.
"""
from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator

# Placeholder names of the extract templates.
COLUMN, START, JOB_START = "<IncrementalColumn>", "<IncrementalStartTime>", "<JobStartTime>"

_TYPED = re.compile(r"\b(timestamp(_ntz|_ltz)?|date|interval)\s*$", re.IGNORECASE)
_OPENS = re.compile(r"--|/\*|['\"`]")
_BRACKET = re.compile(r"/\*|\*/")
# How each kind of quoted text goes on until its end: escapes and doubled quotes are part of it.
_QUOTED = {"'": re.compile(r"'(?:[^'\\]|\\.|'')*'", re.DOTALL), '"': re.compile(r'"(?:[^"\\]|\\.|"")*"', re.DOTALL),
           "`": re.compile(r"`(?:[^`]|``)*`", re.DOTALL)}

CODE, TEXT, NAME, COMMENT = "code", "text", "name", "comment"


def _comment_end(sql: str, at: int) -> int:
    """End of the comment that opens at ``at``; block comments nest."""
    if sql.startswith("--", at):
        end = sql.find("\n", at)
        return len(sql) if end < 0 else end
    depth, end = 0, at
    for m in _BRACKET.finditer(sql, at):
        depth += 1 if m.group() == "/*" else -1
        end = m.end()
        if not depth:
            return end
    raise ValueError(f"comment opened at {at} has no end")


def scan(sql: str) -> Iterator[tuple[str, str]]:
    """(kind, part) of a template, in order; the parts joined are the template."""
    at = 0
    while at < len(sql):
        m = _OPENS.search(sql, at)
        if not m:
            yield CODE, sql[at:]
            return
        if m.start() > at:
            yield CODE, sql[at:m.start()]
        at = m.start()
        if m.group() in ("--", "/*"):
            end = _comment_end(sql, at)
            yield COMMENT, sql[at:end]
        else:
            quoted = _QUOTED[m.group()].match(sql, at)
            if not quoted:
                raise ValueError(f"quote opened at {at} has no end")
            end = quoted.end()
            yield NAME if m.group() == "`" else TEXT, sql[at:end]
        at = end


def bound_query(template: str, column: str, start: dt.datetime,
                job_start: dt.datetime) -> tuple[str, dict]:
    """Template -> (Spark SQL with named parameters, args).

    A placeholder that stands for a whole value becomes a parameter, one inside
    a longer literal or after a type keyword escaped text, and the column a
    quoted name.
    """
    # Bounds travel as text: compared with the column they are read in its own
    # type, so no time zone is applied on the way.
    names = {START: "inc_start", JOB_START: "inc_job_start"}
    values = {START: str(start), JOB_START: str(job_start), COLUMN: column}
    name = ".".join("`" + part.replace("`", "``") + "`" for part in column.split("."))
    out, used, code = [], set(), ""
    for kind, part in scan(template):
        if kind == CODE:
            part = part.replace(COLUMN, name)
            used |= {ph for ph in names if ph in part}
            for ph, param in names.items():
                part = part.replace(ph, f":{param}")
        elif kind == TEXT and part[1:-1] in names and not _TYPED.search(code):
            used.add(part[1:-1])
            part = f":{names[part[1:-1]]}"
        elif kind == TEXT:
            for ph, value in values.items():
                part = part.replace(ph, re.sub(r"(['\"\\])", r"\\\1", value))
        elif kind == NAME:
            for ph, value in values.items():
                part = part.replace(ph, value.replace("`", "``"))
        code = code + part if kind == CODE else code + " " if kind == COMMENT else ""
        out.append(part)
    return "".join(out), {names[ph]: values[ph] for ph in names if ph in used}


def render_query(template: str, column: str, start: dt.datetime, job_start: dt.datetime) -> str:
    """Template with the values pasted in as text, for a remote source and the log."""
    values = {COLUMN: column, START: str(start), JOB_START: str(job_start)}
    out = []
    for kind, part in scan(template):
        if kind != COMMENT:
            for ph, value in values.items():
                part = part.replace(ph, value)
        out.append(part)
    return "".join(out)
