"""Secret scans: assignment-aware lexing beside three fixed patterns.

The lexer reads `name = literal` pairs of source and configuration syntax
(`=`, `:`, `:=`, `=>`, quoted, subscripted, typed and chained names, string
concatenation), propagates constants (`B = A`, `B = $A` and `B = ${A}` give B
the literal of A) and scores each literal by how
sensitive the names are that it reaches.  Spans are code-point offsets into
the whole text, end exclusive.  NULL text counts as empty."""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The three base patterns of the query's contract.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "literal")

#: Parts of names that make a literal assigned to them sensitive, with weights.
SENSITIVE = {"password": 3, "passwd": 3, "passphrase": 3, "pwd": 3, "secret": 3, "token": 2, "apikey": 3,
             "credential": 3, "credentials": 3, "bearer": 2, "privatekey": 3, "accesskey": 3, "auth": 1,
             "key": 1, "private": 1, "access": 1, "api": 1}
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|change_?me|example|placeholder|none|null|true|false|todo|your.*|<.*>|\$.*|\{.*\})$")

STRING = r""""(?:[^"\\\n]|\\.)*+"|'(?:[^'\\\n]|\\.)*+'"""
_WORD = "[A-Za-z0-9_.-]"
_BRACKETS = r"""\[(?:[^\[\]\n"'=]|\[[^\[\]\n"'=]*+\])*+\]|<(?:[^<>\n"'=]|<[^<>\n"'=]*+>)*+>"""
_TYPE = rf"""(?:&(?:'[a-z_]++[ \t]++)?+(?:mut[ \t]++)?+)?+[A-Za-z_][A-Za-z0-9_.]*+(?:::[A-Za-z0-9_]++)*+(?:{_BRACKETS})*+[?*]?+"""
#: A target and its operator: a name of any length, also quoted, subscripted or
#: with a type (`name: type =`).  A run of name characters is tried once, from
#: its start, and blanks are never given back, so the search is linear.
TARGET = re.compile(
    rf"""(?<!{_WORD})(?P<name>{_WORD}++(?:\[[ \t]*+(?:{STRING}|{_WORD}++)[ \t]*+\])*+)["']?+(?:[ \t]*+\])?+(?P<gap>[ \t]*+)"""
    rf"""(?::[ \t]*+(?P<type>{_TYPE}(?:[ \t]*+\|[ \t]*+{_TYPE})*+)(?:[ \t]++=|=(?=[ \t]*+["']))(?![=>])|"""
    r"""(?P<op>:=|=>|==?|:)(?!/))[ \t]*+""")
VALUE = re.compile(rf"""(?:{STRING})(?:[ \t]*+\+[ \t]*+(?:{STRING}))*+|\$\{{{_WORD}++\}}|[^\s"',;#(){{}}\[\]<>]+""")
NAME = re.compile("(?<![A-Za-z0-9_])[A-Za-z_].*", re.DOTALL)
REFERENCE = re.compile(r"\$(?:\{([A-Za-z0-9_.-]+)\}|([A-Za-z0-9_.-]+))")
PART = re.compile(STRING)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")


def name_weight(name: str) -> int:
    """How sensitive a target name is: snake, kebab, dotted or camel parts,
    and neighbouring parts joined (`api_key`, `privateKey`)."""
    parts = [p.lower() for p in NAME_PART.findall(name)]
    joined = [a + b for a, b in zip(parts, parts[1:])]
    return sum(SENSITIVE.get(p, 0) for p in parts + joined)


def literal_weight(value: str) -> int:
    """0 to 3: length, spread of characters, mixed classes; placeholders 0."""
    if len(value) < 6 or PLACEHOLDER.match(value):
        return 0
    n = len(value)
    spread = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    classes = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", r"[^A-Za-z0-9\s]"))
    return (spread >= 2.5) + (classes >= 2) + (n >= 12 and classes >= 2)


def _chained(text: str, first: re.Match) -> list[re.Match]:
    """Targets that follow one another directly: `A = B = `."""
    chain = [first]
    while chain[-1]["type"] or chain[-1]["op"] in ("=", ":="):
        following = TARGET.match(text, chain[-1].end())
        if not following or following["op"] != "=" or not NAME.match(following["name"]):
            break
        chain.append(following)
    return chain


def assignments(text: str):
    """(targets, value) matches in order.  Targets written without blanks
    (`a=b=c`) are chained only if a quoted literal ends the chain: `b=c` may as
    well be a value with its padding."""
    at = 0
    while first := TARGET.search(text, at):
        chain = _chained(text, first)
        last = VALUE.match(text, chain[-1].end())
        quoted = last is not None and last[0][0] in "\"'"
        at, k = first.start(), 0
        while k < len(chain):
            j = k
            while j + 1 < len(chain) and (quoted or (chain[j + 1]["gap"] and (j + 2 < len(chain) or last))):
                j += 1
            value = VALUE.match(text, chain[j].end())
            if value is None and chain[j]["type"]:
                value = VALUE.match(text, chain[j].start("type"))
            if value:
                yield chain[k:j + 1], value
            at, k = (value or chain[j]).end(), j + 1
            while k < len(chain) and chain[k].start() < at:
                k += 1


def _passed_over(targets: list[re.Match]):
    """Spans read as a type or as a further target that look like literals."""
    spans = [(m, m.span("type")) for m in targets if m["type"]]
    spans += [(a, b.span("name")) for a, b in zip(targets, targets[1:])]
    for m, (a, b) in spans:
        literal = m.string[a:b]
        if literal_weight(literal) == 3 and any(c.isdigit() for c in literal):
            yield m, (a, b)


def lexed(text: str, least: int = 5) -> list[tuple[int, int]]:
    """Spans of literals that reach a sensitive name with a score of `least`
    or more (weight of the name plus weight of the literal)."""
    constants: dict[str, tuple[str, tuple[tuple[int, int], ...]]] = {}
    found: set[tuple[int, int]] = set()

    def reach(name: str, value: str, pieces) -> None:
        if (weight := name_weight(name)) >= 2 and (score := literal_weight(value)) and weight + score >= least:
            found.update(p for p in pieces if p[1] > p[0])

    for targets, m in assignments(text):
        raw, at = m[0], m.start()
        if raw[0] in "\"'":
            pieces = [(at + p.start() + 1, at + p.end() - 1) for p in PART.finditer(raw)]
            value = "".join(text[a:b] for a, b in pieces)
            known = (r := REFERENCE.fullmatch(value)) and constants.get(r[1] or r[2])
        else:
            pieces, value = [(at, at + len(raw))], raw
            known = constants.get(raw.strip("${}"))
        if known:
            value, pieces = known[0], list(known[1])
        for t in targets:
            if name := NAME.search(t["name"]):
                constants[name[0]] = (value, tuple(pieces))
                reach(name[0], value, pieces)
        for t, span in _passed_over(targets):
            reach(t["name"], text[slice(*span)], [span])
    return sorted(found)


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) by start, then kind as listed in KINDS."""
    out = [("hex", *m.span()) for m in HEX.finditer(text)]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text)]
    if ":" in text or "=" in text:  # every pattern of a pair holds one of them
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
        out += [("literal", *s) for s in lexed(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: counts per base kind, `base_spans` and `spans`
    as `kind:start:end` joined by commas.  The lexer adds spans only."""

    def find(batches):
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                spans = spans_of(text or "")
                base = [s for s in spans if s[0] != "literal"]
                n = Counter(s[0] for s in base)
                out.append((doc_id, n["assign"], n["access"], n["hex"], joined(base), joined(spans)))
            cols = zip(*out) if out else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 4 + [pa.string()] * 2)],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_spans", "spans"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        find, "doc_id long, n_assign long, n_access long, n_hex long, base_spans string, spans string")
