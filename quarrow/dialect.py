"""Source-dialect SQL text as Spark SQL.

A scanner splits text into tokens, so that nothing inside literals, quoted names
or comments is touched. Rewrites: ``$n`` parameters, casts and type names,
literals, quoted names, array constructors, ``generate_series``, the default
order of nulls, and names of unnamed result columns.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from .types import INTERVAL_DDL, SOURCE_TYPES, UNSUPPORTED, canonical

_TOKEN = re.compile(
    r"""(?P<space>\s+|--[^\n]*|/\*.*?\*/)
      | (?P<text>[eE]?'(?:[^']|'')*')
      | (?P<quoted>"(?:[^"]|"")*")
      | (?P<param>\$[0-9]+)
      | (?P<dollar>\$(?P<tag>[A-Za-z_]*)\$.*?\$(?P=tag)\$)
      | (?P<number>[0-9]+(?:\.[0-9]*)?(?:[eE][+-]?[0-9]+)?|\.[0-9]+(?:[eE][+-]?[0-9]+)?)
      | (?P<word>[A-Za-z_\u0080-￿][A-Za-z0-9_$\u0080-￿]*)
      | (?P<cast>::)
      | (?P<sign>\|\||<>|<=|>=|!=|->>?|.)""",
    re.X | re.S,
)
_CLAUSES = frozenset("FROM WHERE GROUP HAVING ORDER LIMIT OFFSET UNION INTERSECT EXCEPT WINDOW FETCH FOR".split())
_ORDER_ENDS = frozenset("LIMIT OFFSET FETCH FOR ROWS RANGE GROUPS UNION INTERSECT EXCEPT".split())
_TWO_WORDS = {"double": ("precision",), "character": ("varying",), "timestamp": ("with", "without"), "time": ("with", "without")}
#: Words after which a sign belongs to its operand.
_BEFORE_SIGN = ("SELECT", "WHERE", "AND", "OR", "NOT", "ON", "HAVING", "THEN", "ELSE", "WHEN", "BETWEEN", "BY", "CASE", "LIMIT", "OFFSET", "IN", "LIKE")
_NOT_ALIAS = frozenset("END NULL TRUE FALSE".split())


#: Literals, names, brackets and division signs of Spark SQL.
_SIGNS = re.compile(r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`(?:[^`]|``)*`|[()\[\]/]""", re.S)

_NAMED = re.compile(r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`(?:[^`]|``)*`|:(p[0-9]+)""", re.S)


class DialectError(ValueError):
    """Text that no valid statement can have."""


@dataclass
class Token:
    kind: str
    text: str

    def is_word(self, *words: str) -> bool:
        return self.kind == "word" and self.text.upper() in words


@dataclass(frozen=True)
class Rewritten:
    sql: str
    parameters: int


def scan(sql: str) -> list[Token]:
    """Tokens without white space and comments."""
    out = []
    for m in _TOKEN.finditer(sql):
        kind = m.lastgroup if m.lastgroup != "tag" else "dollar"
        if kind != "space":
            out.append(Token(kind, m[0]))
    return out


def literal(value: str) -> str:
    """A string as a Spark literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def text_value(token: Token) -> str:
    """The string that a literal of the source dialect stands for."""
    if token.kind == "dollar":
        mark = token.text.index("$", 1) + 1
        return token.text[mark:-mark]
    plain = token.text[token.text.index("'") + 1 : -1].replace("''", "'")
    if token.text[0] in "eE":
        simple = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f"}
        plain = re.sub(r"\\(.)", lambda m: simple.get(m[1], m[1]), plain, flags=re.S)
    return plain


_UNITS = {"year": (12, 0, 0), "yr": (12, 0, 0), "mon": (1, 0, 0), "month": (1, 0, 0), "week": (0, 7, 0), "day": (0, 1, 0), "hour": (0, 0, 3600), "hr": (0, 0, 3600), "minute": (0, 0, 60), "min": (0, 0, 60), "second": (0, 0, 1), "sec": (0, 0, 1)}


def interval_parts(value: str) -> tuple[int, int, int]:
    """Months, days and nanoseconds of an interval's text."""
    months = days = 0
    seconds = 0.0
    rest = value.strip()
    if not rest:
        raise DialectError(f'invalid input syntax for type interval: "{value}"')
    while rest:
        if m := re.match(r"([+-]?)(\d+):(\d\d)(?::(\d\d(?:\.\d*)?))?\s*", rest):
            sign = -1 if m[1] == "-" else 1
            seconds += sign * (int(m[2]) * 3600 + int(m[3]) * 60 + float(m[4] or 0))
        elif (m := re.match(r"([+-]?\d+(?:\.\d+)?)\s*([A-Za-z]+)\s*", rest)) and (unit := _UNITS.get(m[2].lower().removesuffix("s")) or _UNITS.get(m[2].lower())):
            amount = float(m[1])
            months += int(amount * unit[0])
            days += int(amount * unit[1])
            seconds += amount * unit[2]
        else:
            raise DialectError(f'invalid input syntax for type interval: "{value}"')
        rest = rest[m.end() :]
    return months, days, round(seconds * 1_000_000) * 1000


def numeric_literal(value: str) -> str:
    """A number of any size: a Spark decimal where one holds it, else its text."""
    value = value.strip()
    if re.fullmatch(r"[+-]?(nan|inf|infinity)", value, re.I):
        names = {"nan": "NaN", "inf": "Infinity", "infinity": "Infinity"}
        return literal(("-" if value[0] == "-" else "") + names[value.lstrip("+-").lower()])
    m = re.fullmatch(r"([+-]?)(\d*)(?:\.(\d*))?", value)
    if not m or not (m[2] or m[3]):
        raise DialectError(f'invalid input syntax for type numeric: "{value}"')
    whole, part = (m[2] or "").lstrip("0") or "0", m[3] or ""
    sign = "-" if m[1] == "-" and (whole + part).strip("0") else ""
    shown = sign + whole + (f".{part}" if part else "")
    return f"{shown}BD" if len(whole.lstrip("0")) + len(part) <= 38 else literal(shown)


def _bytes_literal(value: str) -> str:
    if value.startswith("\\x"):
        digits = "".join(value[2:].split())
        if len(digits) % 2 or not re.fullmatch(r"[0-9A-Fa-f]*", digits):
            raise DialectError(f'invalid input syntax for type bytea: "{value}"')
        return f"X'{digits}'"
    raw = re.sub(rb"\\(\\|[0-3][0-7][0-7])", lambda m: b"\\" if m[1] == b"\\" else bytes([int(m[1], 8)]), value.encode())
    return f"X'{raw.hex()}'"


class Rewriter:
    """One pass over the tokens of a statement."""

    def __init__(self, sql: str):
        self.tokens = scan(sql)
        while self.tokens and self.tokens[-1].text == ";":
            self.tokens.pop()
        self.parameters = 0

    def rewritten(self) -> Rewritten:
        tokens = self._named(self._null_orders(self.tokens))
        out = self._body(tokens)
        return Rewritten(" ".join(t.text for t in out).replace(" . ", "."), self.parameters)

    # Names of unnamed columns -------------------------------------------------

    def _named(self, tokens: list[Token]) -> list[Token]:
        """Aliases for the unnamed columns of the outermost SELECT."""
        depth, start = 0, None
        for k, token in enumerate(tokens):
            depth += (token.text == "(") - (token.text == ")")
            if depth == 0 and token.is_word("SELECT"):
                start = k + 1
                break
        if start is None:
            return tokens
        if start < len(tokens) and tokens[start].is_word("DISTINCT", "ALL"):
            start += 1
        out, item, depth, k = tokens[:start], [], 0, start
        while k < len(tokens):
            token = tokens[k]
            ends = depth == 0 and (token.text == "," or (token.kind == "word" and token.text.upper() in _CLAUSES))
            if ends:
                out += self._with_name(item)
                item = []
                if token.text != ",":
                    break
                out.append(token)
            else:
                depth += (token.text in "([") - (token.text in ")]")
                item.append(token)
            k += 1
        return out + self._with_name(item) + tokens[k:]

    def _with_name(self, item: list[Token]) -> list[Token]:
        if not item or item[-1].text == "*" or (len(item) > 1 and item[-2].is_word("AS")):
            return item
        name, last, before = "?column?", item[-1], item[-2] if len(item) > 1 else None
        depth, cast, mixed = 0, None, False
        for k, token in enumerate(item):
            depth += (token.text in "([") - (token.text in ")]")
            if depth == 0 and token.kind == "cast":
                cast = k
            mixed |= depth == 0 and token.kind == "sign" and token.text not in ")]."
        if mixed:
            cast = None
        if cast is not None and (kind := self._type_at(item, cast + 1)) and kind[1] == len(item):
            name = kind[3] or item[cast + 1].text.strip('"').lower()
        elif last.kind in ("word", "quoted") and not last.text.upper() in _NOT_ALIAS:
            if before is None or before.text == ".":
                return item
            if before.kind in ("word", "text", "number", "param", "quoted") or before.text in ")]":
                if not before.is_word("NOT", "AND", "OR", "IN", "LIKE", "IS", "BETWEEN", "ELSE", "THEN", "WHEN"):
                    return item
        elif last.is_word("TRUE", "FALSE") and before is None:
            name = "bool"
        elif last.is_word("END") and item[0].is_word("CASE"):
            name = "case"
        elif last.text == ")" and item[0].kind == "word" and len(item) > 1 and item[1].text == "(" and self._closes(item, 1) == len(item) - 1:
            name = item[0].text.lower()
        elif item[0].is_word("ARRAY"):
            name = "array"
        return [*item, Token("word", "AS"), Token("name", f"`{name}`")]

    @staticmethod
    def _closes(tokens: list[Token], at: int) -> int:
        """Where the bracket at ``at`` closes."""
        depth = 0
        for k in range(at, len(tokens)):
            depth += (tokens[k].text in "([") - (tokens[k].text in ")]")
            if depth == 0:
                return k
        raise DialectError("syntax error at end of input")

    # Order of nulls -----------------------------------------------------------

    def _null_orders(self, tokens: list[Token]) -> list[Token]:
        """Nulls as the largest values, where ORDER BY does not say."""
        out: list[Token] = []
        open_at: list[int] = []  # depths at which an ORDER BY is open
        depth, item = 0, []

        def close() -> None:
            if item and not any(t.is_word("NULLS") for t in item):
                descending = any(t.is_word("DESC") for t in item[-1:])
                out.extend([Token("word", "NULLS"), Token("word", "FIRST" if descending else "LAST")])
            item.clear()

        for k, token in enumerate(tokens):
            if open_at and depth == open_at[-1]:
                if token.text == "," or token.text == ")" or (token.kind == "word" and token.text.upper() in _ORDER_ENDS):
                    close()
                    if token.text != ",":
                        open_at.pop()
            depth += (token.text in "([") - (token.text in ")]")
            out.append(token)
            if token.is_word("BY") and k and tokens[k - 1].is_word("ORDER"):
                open_at.append(depth)
                item.clear()
            elif open_at and depth >= open_at[-1] and token.text != ",":
                item.append(token)
        if open_at:
            close()
        return out

    # Everything else ----------------------------------------------------------

    def _type_at(self, tokens: list[Token], k: int) -> tuple[str, int, list[str], str | None] | None:
        """``(name, end, modifiers, canonical)`` of the type name at ``k``."""
        if k >= len(tokens):
            raise DialectError("syntax error at end of input")
        token = tokens[k]
        if token.kind == "quoted":
            return ("char", k + 1, [], "char") if token.text.lower() == '"char"' else None
        if token.kind != "word":
            return None
        name, k = token.text.lower(), k + 1
        if k < len(tokens) and tokens[k].text.lower() in _TWO_WORDS.get(name, ()):
            follow = tokens[k].text.lower()
            if follow in ("with", "without"):
                if [t.text.lower() for t in tokens[k + 1 : k + 3]] == ["time", "zone"]:
                    name, k = f"{name} {follow} time zone", k + 3
            else:
                name, k = f"{name} {follow}", k + 1
        modifiers: list[str] = []
        if k < len(tokens) and tokens[k].text == "(":
            end = self._closes(tokens, k)
            modifiers = [t.text for t in tokens[k + 1 : end] if t.text != ","]
            k = end + 1
        kind = canonical(name)
        if name in ("char", "character") and token.kind == "word":
            kind, modifiers = "bpchar", modifiers or ["1"]
        if k + 1 < len(tokens) and tokens[k].text == "[" and tokens[k + 1].text == "]":
            return f"{name}[]", k + 2, [], None
        return name, k, modifiers, kind

    @staticmethod
    def _operand(out: list[Token]) -> int:
        """Where the operand that ends ``out`` starts."""
        k = len(out) - 1
        if k < 0:
            raise DialectError('syntax error at or near "::"')
        if out[k].text in (")", "]"):
            depth = 0
            while k >= 0:
                depth += (out[k].text in ")]") - (out[k].text in "([")
                if depth == 0:
                    break
                k -= 1
            if k > 0 and out[k - 1].kind in ("word", "name") and not out[k - 1].is_word("IN", "AND", "OR", "NOT", "SELECT", "WHERE", "THEN", "ELSE", "WHEN", "ON", "BY", "AS", "LIKE", "VALUES"):
                k -= 1
        while k > 1 and out[k - 1].text == "." and out[k].kind in ("word", "name"):
            k -= 2
        return k

    def _cast(self, operand: list[Token], name: str, modifiers: list[str], kind: str | None) -> Token:
        sql = " ".join(t.text for t in operand)
        alone = operand[0] if len(operand) == 1 else None
        if kind is None:
            if name == "json" and alone is not None and alone.kind == "string":
                try:
                    json.loads(alone.value)  # type: ignore[attr-defined]
                except ValueError:
                    raise DialectError("invalid input syntax for type json") from None
            if name in UNSUPPORTED or name.endswith("[]"):
                return Token("done", f"named_struct('unsupported type {name}', {sql})")
            raise DialectError(f'type "{name}" does not exist')
        value = getattr(alone, "value", None)
        if value is not None and kind == "bytea":
            return Token("done", _bytes_literal(value))
        if value is not None and kind == "interval":
            months, days, nanoseconds = interval_parts(value)
            return Token("done", f"named_struct('months', {months}, 'days', {days}, 'nanoseconds', CAST({nanoseconds} AS BIGINT))")
        if kind == "interval" and alone is not None and alone.is_word("NULL"):
            return Token("done", f"CAST(NULL AS {INTERVAL_DDL})")
        if kind == "numeric" and not modifiers and (value is not None or (alone is not None and alone.kind == "number")):
            return Token("done", numeric_literal(value if value is not None else alone.text))
        if value is not None and kind == "timestamptz":
            sql = literal(re.sub(r"([+-]\d\d)$", r"\1:00", value.strip()))
        if value is not None and kind == "bool":
            truth = value.strip().lower()
            sql = {"on": "'true'", "off": "'false'"}.get(truth, sql)
        spec = SOURCE_TYPES[kind]
        if modifiers and spec.sized:
            precise = modifiers if kind != "numeric" or len(modifiers) > 1 else [*modifiers, "0"]
            return Token("done", spec.sized.format(x=sql, n=modifiers[0], m=", ".join(precise)))
        return Token("done", spec.cast.format(x=sql))

    def _body(self, tokens: list[Token]) -> list[Token]:
        out: list[Token] = []
        clause = {0: ""}
        depth, k = 0, 0
        arrays: list[int] = []
        while k < len(tokens):
            token = tokens[k]
            if token.kind in ("text", "dollar"):
                value = text_value(token)
                new = Token("string", literal(value))
                new.value = value  # type: ignore[attr-defined]
                out.append(new)
            elif token.kind == "quoted":
                out.append(Token("name", "`" + token.text[1:-1].replace('""', '"').replace("`", "``") + "`"))
            elif token.kind == "param":
                number = int(token.text[1:])
                if not number:
                    raise DialectError("there is no parameter $0")
                self.parameters = max(self.parameters, number)
                out.append(Token("param", f":p{number}"))
            elif token.kind == "cast":
                kind = self._type_at(tokens, k + 1)
                if kind is None:
                    raise DialectError(f'syntax error at or near "{tokens[k + 1].text}"')
                start = self._operand(out)
                out[start:] = [self._cast(out[start:], kind[0], kind[2], kind[3])]
                k = kind[1]
                continue
            elif token.text == "~" and out and (out[-1].text == "!" or out[-1].kind != "sign" or out[-1].text in ")]"):
                if out[-1].text == "!":
                    out[-1] = Token("word", "NOT")
                out.append(Token("word", "RLIKE"))
                if k + 2 < len(tokens) and tokens[k + 1].text == "*" and tokens[k + 2].kind in ("text", "dollar", "param"):
                    out += [Token("done", "concat('(?i)',"), *self._body(tokens[k + 2 : k + 3]), Token("done", ")")]
                    k += 3
                    continue
            elif token.text == "^" and token.kind == "sign":
                k = self._power(tokens, k, out)
                continue
            elif token.is_word("CAST") and k + 1 < len(tokens) and tokens[k + 1].text == "(":
                end = self._closes(tokens, k + 1)
                mark = max((j for j in range(k + 2, end) if tokens[j].is_word("AS")), default=None)
                kind = mark and self._type_at(tokens[:end], mark + 1)
                if not kind or kind[1] != end:
                    raise DialectError('syntax error at or near "CAST"')
                out.append(self._cast(self._body(tokens[k + 2 : mark]), kind[0], kind[2], kind[3]))
                k = end + 1
                continue
            elif token.is_word("GENERATE_SERIES") and k + 1 < len(tokens) and tokens[k + 1].text == "(":
                k = self._series(tokens, k, out, clause.get(depth, ""))
                continue
            elif token.is_word("GEN_RANDOM_UUID") and k + 2 < len(tokens) and tokens[k + 1].text == "(":
                out.append(Token("done", "named_struct('unsupported type uuid', uuid())"))
                k += 3
                continue
            elif token.is_word("ARRAY") and k + 1 < len(tokens) and tokens[k + 1].text == "[":
                out += [Token("word", "array"), Token("sign", "(")]
                depth += 1
                arrays.append(depth)
                k += 2
                continue
            elif token.text == "]" and arrays and arrays[-1] == depth:
                arrays.pop()
                depth -= 1
                out.append(Token("sign", ")"))
            else:
                if token.text in "([":
                    depth += 1
                    clause[depth] = ""
                elif token.text in ")]":
                    depth -= 1
                    if depth < 0:
                        raise DialectError('syntax error at or near ")"')
                elif token.is_word("SELECT", "FROM", "JOIN", "WHERE", "GROUP", "HAVING", "ORDER", "LIMIT"):
                    clause[depth] = token.text.upper()
                out.append(token)
            k += 1
        if depth:
            raise DialectError("syntax error at end of input")
        return out

    def _power(self, tokens: list[Token], k: int, out: list[Token]) -> int:
        """``a ^ b`` as a power; a sign before either operand belongs to it, as do casts."""
        if not out:
            raise DialectError('syntax error at or near "^"')
        start = self._operand(out)
        if start and out[start - 1].text in ("-", "+") and (start == 1 or (out[start - 2].kind == "sign" and out[start - 2].text not in ")]") or out[start - 2].is_word(*_BEFORE_SIGN)):
            start -= 1
        end = k + 1
        while end < len(tokens) and tokens[end].text in ("-", "+"):
            end += 1
        if end < len(tokens) and tokens[end].kind in ("word", "quoted"):
            while end + 2 < len(tokens) and tokens[end + 1].text == ".":
                end += 2
            if end + 1 < len(tokens) and tokens[end + 1].text == "(":
                end += 1
        if end >= len(tokens):
            raise DialectError("syntax error at end of input")
        end = self._closes(tokens, end) + 1 if tokens[end].text == "(" else end + 1
        while end < len(tokens) and tokens[end].kind == "cast":
            kind = self._type_at(tokens, end + 1)
            if kind is None:
                raise DialectError('syntax error at or near "::"')
            end = kind[1]
        left, right = (" ".join(t.text for t in part) for part in (out[start:], self._body(tokens[k + 1 : end])))
        out[start:] = [Token("done", f"power({left}, {right})")]
        return end

    def _series(self, tokens: list[Token], k: int, out: list[Token], clause: str) -> int:
        """``generate_series``: a range in FROM, else rows of a sequence."""
        end = self._closes(tokens, k + 1)
        parts, depth = [[]], 0
        for token in tokens[k + 2 : end]:
            depth += (token.text in "([") - (token.text in ")]")
            if token.text == "," and not depth:
                parts.append([])
            else:
                parts[-1].append(token)
        args = [" ".join(t.text for t in self._body(p)) for p in parts]
        if len(args) not in (2, 3):
            raise DialectError("function generate_series does not exist for these arguments")
        constant = all(re.fullmatch(r"-? ?[0-9]+", a) for a in args)
        small = constant and all(abs(int(a.replace(" ", ""))) < 1 << 31 for a in args)
        if clause not in ("FROM", "JOIN"):
            out.append(Token("done", f"explode(sequence({', '.join(args)}))"))
            return end + 1
        k = end + 1
        name, column = "generate_series", None
        if k < len(tokens) and tokens[k].is_word("AS"):
            k += 1
        if k < len(tokens) and tokens[k].kind in ("word", "quoted") and not tokens[k].is_word(*_CLAUSES, "JOIN", "INNER", "LEFT", "RIGHT", "FULL", "CROSS", "ON", "USING", "NATURAL"):
            name, k = tokens[k].text.strip('"'), k + 1
            if k + 2 < len(tokens) and tokens[k].text == "(" and tokens[k + 2].text == ")":
                column, k = tokens[k + 1].text.strip('"'), k + 3
        column = column or name
        kind = "INT" if small else "BIGINT"
        if constant:
            step = int(args[2].replace(" ", "")) if len(args) == 3 else 1
            if not step:
                raise DialectError("step size cannot equal zero")
            source = f"SELECT CAST(id AS {kind}) AS `{column}` FROM range({args[0]}, {args[1]} {'+' if step > 0 else '-'} 1, {step})"
        else:
            source = f"SELECT explode(sequence({', '.join(args)})) AS `{column}`"
        out.append(Token("done", f"({source}) AS `{name}`"))
        return k


def parameters(sql: str) -> list[re.Match]:
    """The parameters ``:name`` of Spark SQL, with the name as first group."""
    return [m for m in _NAMED.finditer(sql) if m[1]]


def divided(sql: str, spans: list[tuple[int, int, str]]) -> str:
    """Spark SQL in which the divisions at ``(first, last, type)`` are whole ones of that type.

    Spans are of characters, both ends included; each is one division, whose sign
    is the last outside of its brackets. Spans do not overlap.
    """
    for first, last, kind in sorted(spans, reverse=True):
        depth, sign = 0, None
        for m in _SIGNS.finditer(sql, first, last + 1):
            depth += (m[0] in "([") - (m[0] in ")]")
            if m[0] == "/" and not depth:
                sign = m.start()
        if sign is not None:
            whole = f"CAST(({sql[first:sign]} div {sql[sign + 1 : last + 1]}) AS {kind})"
            sql = sql[:first] + whole + sql[last + 1 :]
    return sql


def rewrite(sql: str) -> Rewritten:
    """A statement of the source dialect as Spark SQL with ``:p1``, ``:p2``, ... parameters."""
    return Rewriter(sql).rewritten()
