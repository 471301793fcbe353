"""A sandboxed template language for chats, compiled to closures.

Text, {{ expressions }}, {# comments #} and {% blocks %}: if / elif / else, for (with `if` and else), set, generation. A `-` inside a mark strips
the white space beside it. Expressions, loosest first: `a if c else b`; `or`; `and`; `not`; `==` `!=` `<` `<=` `>` `>=` `in` `not in` `is`;
`~`; `+` `-`; `*` `/` `//` `%`; `-x`; then `.name`, `[index]`, `[from:to:step]`, `.method(...)` and `| filter(...)`. Literals are 'strings', "strings",
numbers, true, false, none, [lists], (tuples) and {'dicts': ...}.

Names reach only the values given to render(); attributes are dict keys; the only calls are the METHODS of texts and
dicts, the FILTERS, `range`, `namespace` and `raise_exception`; names that begin with _ are refused. Constant parts are folded when the
template is compiled.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass

MARKS = re.compile(r"(\{\{.*?\}\}|\{%.*?%\}|\{#.*?#\})", re.S)
LEXEME = re.compile(r"""\s*(?:(\d+\.\d+|\d+)|'((?:[^'\\]|\\.)*)'|"((?:[^"\\]|\\.)*)"|(==|!=|<=|>=|//|[()\[\]{}<>|.+\-*/%~,:=])|([A-Za-z_]\w*))""", re.S)
WORDS = {"or", "and", "not", "in", "is", "if", "else"}
LITERALS = {"true": True, "True": True, "false": False, "False": False, "none": None, "None": None}
MOST_RANGE = 100_000


def escape(text: str) -> str:
    """Break up control strings: a backslash after every [ and <. No escaped text holds [INST], </s> or the like."""
    return text.replace("[", "[\\").replace("<", "<\\")


def unescape(text: str) -> str:
    """The inverse of escape()."""
    return text.replace("[\\", "[").replace("<\\", "<")


class TemplateError(ValueError):
    """What a template raises by itself, or does that it must not."""


def _raise(message="") -> None:
    raise TemplateError(str(message))


def _range(*args) -> list[int]:
    held = range(*args)
    if len(held) > MOST_RANGE:
        raise TemplateError("range too long")
    return list(held)


FILTERS: dict[str, Callable] = {
    "escape": lambda x: escape(_text(x)), "trim": lambda x: _text(x).strip(), "upper": lambda x: _text(x).upper(), "lower": lambda x: _text(x).lower(), "title": lambda x: _text(x).title(),
    "capitalize": lambda x: _text(x).capitalize(), "replace": lambda x, old, new: _text(x).replace(old, new), "string": lambda x: _text(x), "length": lambda x: len(x or ()), "count": lambda x: len(x or ()),
    "default": lambda x, other="", blank=False: other if x is None or (blank and not x) else x, "join": lambda x, by="": _text(by).join(map(_text, x or ())), "first": lambda x: x[0] if x else None, "last": lambda x: x[-1] if x else None,
    "list": lambda x: list(x or ()), "int": lambda x, other=0: int(x) if re.fullmatch(r"\s*-?\d+\s*", _text(x)) else other, "tojson": lambda x, indent=None: json.dumps(x, ensure_ascii=False, indent=indent), "items": lambda x: list((x or {}).items()),
    "reverse": lambda x: x[::-1], "unique": lambda x: list(dict.fromkeys(x or ())),
}
METHODS: dict[type, dict[str, Callable]] = {
    str: {name: getattr(str, name) for name in ("strip", "lstrip", "rstrip", "lower", "upper", "title", "capitalize", "startswith", "endswith", "split", "replace", "find", "count")},
    dict: {"get": dict.get, "items": lambda d: list(d.items()), "keys": lambda d: list(d), "values": lambda d: list(d.values())},
}
FUNCTIONS: dict[str, Callable] = {"range": _range, "raise_exception": _raise, "namespace": lambda **values: dict(values)}
TESTS: dict[str, Callable] = {
    "defined": lambda x: x is not None, "undefined": lambda x: x is None, "none": lambda x: x is None, "string": lambda x: isinstance(x, str), "mapping": lambda x: isinstance(x, dict),
    "sequence": lambda x: isinstance(x, (str, list, tuple, dict)), "iterable": lambda x: isinstance(x, (str, list, tuple, dict)), "number": lambda x: isinstance(x, (int, float)) and not isinstance(x, bool),
    "boolean": lambda x: isinstance(x, bool), "true": lambda x: x is True, "false": lambda x: x is False, "odd": lambda x: x % 2 == 1, "even": lambda x: x % 2 == 0,
}


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Call:
    """An operation: operators by their sign, '|name' a filter, 'is name' a test, '.name()' a method, 'name()' a function."""

    op: str
    args: tuple
    named: tuple = ()


@dataclass(frozen=True)
class If:
    branches: tuple  # (condition, body) pairs
    other: tuple


@dataclass(frozen=True)
class For:
    names: tuple
    source: object
    where: object
    body: tuple
    other: tuple


@dataclass(frozen=True)
class Assign:
    path: tuple[str, ...]
    value: object


@dataclass(frozen=True)
class Generation:
    body: tuple


def _plus(a, b):
    """Numbers and lists add up; anything else is joined as text."""
    numbers = all(isinstance(x, (int, float)) for x in (a, b))
    return a + b if numbers or (isinstance(a, list) and isinstance(b, list)) else _text(a) + _text(b)


def _compared(op: Callable) -> Callable:
    def compare(a, b):
        try:
            return op(a, b)
        except TypeError as error:
            raise TemplateError(f"cannot compare {type(a).__name__} and {type(b).__name__}") from error

    return compare


def _item(value, key):
    if isinstance(value, dict):
        return value.get(key)
    if isinstance(value, (list, tuple, str)) and isinstance(key, int):
        return value[key] if -len(value) <= key < len(value) else None
    return None


def _inside(a, b) -> bool:
    return b is not None and (str(a) in b if isinstance(b, str) else a in b)


OPS: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": _compared(lambda a, b: a < b), "<=": _compared(lambda a, b: a <= b), ">": _compared(lambda a, b: a > b), ">=": _compared(lambda a, b: a >= b),
    "in": _inside, "not in": lambda a, b: not _inside(a, b), "~": lambda a, b: _text(a) + _text(b), "+": _plus, "-": lambda a, b: a - b, "*": lambda a, b: a * b if not isinstance(a, str) else _raise("texts are not multiplied"),
    "/": lambda a, b: a / b, "//": lambda a, b: a // b, "%": lambda a, b: a % b if not isinstance(a, str) else _raise("texts are not formatted"), "neg": lambda a: -a, "not": lambda a: not a,
    "item": _item, "slice": lambda x, a, b, c: (x or "")[a:b:c], "list": lambda *x: list(x), "tuple": lambda *x: x, "dict": lambda *x: dict(zip(x[::2], x[1::2])),
}


class _Expression:
    def __init__(self, text: str):
        self.tokens, at, text = [], 0, text.strip()
        while at < len(text):
            found = LEXEME.match(text, at)
            if not found:
                raise ValueError(f"cannot read {text[at:]!r} in a template expression")
            number, single, double, sign, word = found.groups()
            string = single if single is not None else double
            if number:
                self.tokens.append(("const", float(number) if "." in number else int(number)))
            elif string is not None:
                self.tokens.append(("const", re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t", "r": "\r"}.get(m[1], m[1]), string, flags=re.S)))
            elif word in LITERALS:
                self.tokens.append(("const", LITERALS[word]))
            else:
                self.tokens.append(("sign", sign or word) if sign or word in WORDS else ("name", word))
            at = found.end()
        self.at = 0

    def peek(self, *signs: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] == "sign" and self.tokens[self.at][1] in signs

    def next(self, *signs: str) -> str | None:
        if self.peek(*signs):
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, sign: str) -> None:
        if not self.next(sign):
            raise ValueError(f"missing {sign} in a template expression")

    def name(self) -> str:
        kind, word = self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")
        if kind != "name" or word.startswith("_"):
            raise ValueError(f"no name {word!r}")
        self.at += 1
        return word

    def done(self) -> None:
        if self.at < len(self.tokens):
            raise ValueError(f"unexpected {self.tokens[self.at][1]!r} in a template expression")

    def parse(self):
        tree = self.choice()
        self.done()
        return tree

    def choice(self):
        tree = self._left(self._both, "or")
        if self.next("if"):
            condition = self._left(self._both, "or")
            other = self.choice() if self.next("else") else Const(None)
            return _fold(Call("if", (condition, tree, other)))
        return tree

    def _left(self, part, *signs):
        tree = part()
        while sign := self.next(*signs):
            tree = _fold(Call(sign, (tree, part())))
        return tree

    def _both(self):
        return self._left(self._negated, "and")

    def _negated(self):
        return _fold(Call("not", (self._negated(),))) if self.next("not") else self._compare()

    def _compare(self):
        tree = self._left(self._sum, "~")
        while True:
            if sign := self.next("==", "!=", "<", "<=", ">", ">=", "in"):
                tree = _fold(Call(sign, (tree, self._left(self._sum, "~"))))
            elif self.peek("not") and self.tokens[self.at + 1 : self.at + 2] == [("sign", "in")]:
                self.at += 2
                tree = _fold(Call("not in", (tree, self._left(self._sum, "~"))))
            elif self.next("is"):
                tree = self._test(tree)
            else:
                return tree

    def _test(self, tree):
        negated = bool(self.next("not"))
        kind, word = self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")
        word = {True: "true", False: "false", None: "none"}.get(word, word) if kind == "const" else word
        if word not in TESTS:
            raise ValueError(f"no test {word!r}")
        self.at += 1
        made = _fold(Call(f"is {word}", (tree,)))
        return _fold(Call("not", (made,))) if negated else made

    def _sum(self):
        return self._left(lambda: self._left(self._signed, "*", "/", "//", "%"), "+", "-")

    def _signed(self):
        return _fold(Call("neg", (self._signed(),))) if self.next("-") else self._filtered()

    def _filtered(self):
        tree = self._reached()
        while self.next("|"):
            name = self.name()
            if name not in FILTERS:
                raise ValueError(f"no filter {name!r}")
            args, named = self._arguments() if self.next("(") else ((), ())
            tree = _fold(Call(f"|{name}", (tree, *args), named))
        return tree

    def _arguments(self) -> tuple[tuple, tuple]:
        args, named = [], []
        while not self.next(")"):
            if self.at + 1 < len(self.tokens) and self.tokens[self.at][0] == "name" and self.tokens[self.at + 1] == ("sign", "="):
                key = self.name()
                self.at += 1
                named.append((key, self.choice()))
            else:
                args.append(self.choice())
            if not self.peek(")"):
                self.need(",")
        return tuple(args), tuple(named)

    def _reached(self):
        tree = self._atom()
        while sign := self.next(".", "["):
            if sign == ".":
                name = self.name()
                if self.next("("):
                    if not any(name in held for held in METHODS.values()):
                        raise ValueError(f"no method {name!r}")
                    args, named = self._arguments()
                    tree = Call(f".{name}()", (tree, *args), named)
                else:
                    tree = _fold(Call("item", (tree, Const(name))))
                continue
            parts, sliced = [None, None, None], False
            for k in range(3):
                if not self.peek(":", "]"):
                    parts[k] = self.choice()
                if not self.next(":"):
                    break
                sliced = True
            self.need("]")
            tree = _fold(Call("slice", (tree, *(p or Const(None) for p in parts))) if sliced else Call("item", (tree, parts[0] or Const(None))))
        return tree

    def _several(self, end: str) -> list:
        out = []
        while not self.next(end):
            out.append(self.choice())
            if not self.peek(end):
                self.need(",")
        return out

    def _atom(self):
        if self.next("("):
            tree = self.choice()
            if self.next(","):
                return _fold(Call("tuple", (tree, *self._several(")"))))
            self.need(")")
            return tree
        if self.next("["):
            return _fold(Call("list", tuple(self._several("]"))))
        if self.next("{"):
            out = []
            while not self.next("}"):
                out.append(self.choice())
                self.need(":")
                out.append(self.choice())
                if not self.peek("}"):
                    self.need(",")
            return _fold(Call("dict", tuple(out)))
        if self.at >= len(self.tokens) or self.tokens[self.at][0] == "sign":
            raise ValueError("missing value in a template expression")
        kind, value = self.tokens[self.at]
        if kind == "const":
            self.at += 1
            return Const(value)
        name = self.name()
        if self.next("("):
            if name not in FUNCTIONS:
                raise ValueError(f"no function {name!r}")
            args, named = self._arguments()
            return Call(f"{name}()", args, named)
        return Name(name)


def _fold(call: Call):
    """A call of constants is a constant; `or`, `and` and `if` with a constant condition are one of their sides."""
    if call.op in ("or", "and") and isinstance(call.args[0], Const):
        return call.args[(call.op == "and") == bool(call.args[0].value)]
    if call.op == "if" and isinstance(call.args[0], Const):
        return call.args[1 if call.args[0].value else 2]
    if call.op not in ("or", "and", "if") and not call.named and all(isinstance(a, Const) for a in call.args):
        try:
            return Const(_function(call.op)(*(a.value for a in call.args)))
        except (TypeError, ValueError, ArithmeticError):
            return call  # it fails when it is rendered, if it is
    return call


def _function(op: str) -> Callable:
    if op.startswith("|"):
        return FILTERS[op[1:]]
    if op.startswith("is "):
        return TESTS[op[3:]]
    if op.startswith("."):
        name = op[1:-2]

        def method(value, *args, **named):
            found = METHODS.get(type(value), {}).get(name)
            if found is None:
                raise TemplateError(f"{type(value).__name__} has no method {name}")
            return found(value, *args, **named)

        return method
    return FUNCTIONS[op[:-2]] if op.endswith("()") else OPS[op]


def _text(value) -> str:
    return "" if value is None else str(value)


def _pieces(source: str, trim_blocks: bool, lstrip_blocks: bool) -> list[str]:
    """Text and marks in turn, with the white space beside marks taken off as they and the options say."""
    parts = MARKS.split(source)
    for k in range(1, len(parts), 2):
        mark = parts[k]
        block = mark.startswith(("{%", "{#"))
        if mark[2] == "-":
            parts[k - 1] = parts[k - 1].rstrip()
            mark = mark[:2] + mark[3:]
        elif lstrip_blocks and block and mark[2] != "+":
            line = parts[k - 1].rpartition("\n")
            if not line[2].strip() and (line[1] or k == 1):
                parts[k - 1] = line[0] + line[1]
        if mark[-3] == "-" and len(mark) > 4:
            parts[k + 1] = parts[k + 1].lstrip()
            mark = mark[:-3] + mark[-2:]
        elif trim_blocks and block:
            parts[k + 1] = parts[k + 1].removeprefix("\n")
        parts[k] = mark
    return [p for p in parts if not p.startswith("{#")]


def parse(source: str, trim_blocks: bool = False, lstrip_blocks: bool = False) -> tuple:
    """The syntax tree of a template, with constants folded and neighbouring text joined."""
    parts = iter(_pieces(source, trim_blocks, lstrip_blocks))

    def condition(text: str):
        return _Expression(text).parse()

    def body(*ends: str) -> tuple[tuple, str]:
        nodes: list = []
        for part in parts:
            if part.startswith("{{"):
                tree = condition(part[2:-2])
                nodes.append(Const(_text(tree.value)) if isinstance(tree, Const) else tree)
            elif part.startswith("{%"):
                word, _, rest = part[2:-2].strip().partition(" ")
                if word in ends:
                    return _join(nodes), f"{word} {rest}".strip()
                if word == "if":
                    nodes.extend(choice(rest))
                elif word == "for":
                    nodes.append(loop(rest))
                elif word == "set":
                    left, sign, right = rest.partition("=")
                    path = tuple(left.strip().split("."))
                    if not sign or len(path) > 2 or not all(re.fullmatch(r"[A-Za-z]\w*", p) for p in path):
                        raise ValueError(f"cannot set {left.strip()!r}")
                    nodes.append(Assign(path, condition(right)))
                elif word == "generation":
                    inner, _ = body("endgeneration")
                    nodes.append(Generation(inner))
                else:
                    raise ValueError(f"unknown block {word!r}")
            elif part:
                nodes.append(Const(part))
        if ends:
            raise ValueError(f"missing {ends[-1]}")
        return _join(nodes), ""

    def choice(rest: str) -> list:
        branches, other, head = [], (), condition(rest)
        while True:
            inner, end = body("elif", "else", "endif")
            branches.append((head, inner))
            if end.startswith("elif"):
                head = condition(end[4:])
                continue
            if end == "else":
                other, _ = body("endif")
            break
        kept = []
        for head, inner in branches:  # a constant condition ends the chain or drops out of it, wherever it stands
            if not isinstance(head, Const):
                kept.append((head, inner))
            elif head.value:
                other = inner
                break
        return [If(tuple(kept), other)] if kept else list(other)

    def loop(rest: str) -> For:
        names, sign, where = rest.partition(" in ")
        names = tuple(n.strip() for n in names.split(","))
        if not sign or not all(re.fullmatch(r"[A-Za-z]\w*", n) for n in names):
            raise ValueError(f"cannot read for {rest!r}")
        held = _Expression(where)
        source = held._left(held._both, "or")
        only = held.choice() if held.next("if") else None
        held.done()
        inner, end = body("else", "endfor")
        other = body("endfor")[0] if end == "else" else ()
        return For(names, source, only, inner, other)

    return body()[0]


def _join(nodes: list) -> tuple:
    out: list = []
    for node in nodes:
        if isinstance(node, Const) and out and isinstance(out[-1], Const):
            out[-1] = Const(out[-1].value + node.value)
        elif not (isinstance(node, Const) and node.value == ""):
            out.append(node)
    return tuple(out)


class _Out:
    def __init__(self):
        self.parts, self.length, self.spans = [], 0, []

    def add(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)


def _value(tree) -> Callable[[dict], object]:
    if isinstance(tree, Const):
        return lambda scope, value=tree.value: value
    if isinstance(tree, Name):
        return lambda scope, name=tree.name: scope.get(name)
    args = [_value(a) for a in tree.args]
    if tree.op == "or":
        return lambda scope: args[0](scope) or args[1](scope)
    if tree.op == "and":
        return lambda scope: args[0](scope) and args[1](scope)
    if tree.op == "if":
        return lambda scope: args[1](scope) if args[0](scope) else args[2](scope)
    function, named = _function(tree.op), [(k, _value(v)) for k, v in tree.named]
    if named:
        return lambda scope: function(*(a(scope) for a in args), **{k: v(scope) for k, v in named})
    if len(args) == 1:
        return lambda scope, a=args[0]: function(a(scope))
    if len(args) == 2:
        return lambda scope, a=args[0], b=args[1]: function(a(scope), b(scope))
    return lambda scope: function(*(a(scope) for a in args))


def _writer(nodes: tuple) -> Callable[[dict, _Out], None]:
    steps = [_step(n) for n in nodes]

    def run(scope, out):
        for step in steps:
            step(scope, out)

    return run


def _looper(node: For) -> Callable[[dict, _Out], None]:
    source, inner, other = _value(node.source), _writer(node.body), _writer(node.other)
    only = None if node.where is None else _value(node.where)

    def bound(row) -> dict:
        return {node.names[0]: row} if len(node.names) == 1 else dict(zip(node.names, row, strict=True))

    def loop(scope, out):
        rows = [bound(row) for row in source(scope) or ()]
        if only is not None:
            rows = [row for row in rows if only(scope | row)]
        for i, row in enumerate(rows):
            place = {"index": i + 1, "index0": i, "first": i == 0, "last": i == len(rows) - 1, "length": len(rows), "revindex": len(rows) - i, "revindex0": len(rows) - i - 1,
                     "previtem": rows[i - 1][node.names[0]] if i else None, "nextitem": rows[i + 1][node.names[0]] if i + 1 < len(rows) else None}
            inner(scope | row | {"loop": place}, out)
        if not rows:
            other(scope, out)

    return loop


def _step(node) -> Callable[[dict, _Out], None]:
    if isinstance(node, Const):
        return lambda scope, out, text=node.value: out.add(text)
    if isinstance(node, If):
        branches, other = [(_value(c), _writer(b)) for c, b in node.branches], _writer(node.other)

        def choose(scope, out):
            for condition, then in branches:
                if condition(scope):
                    return then(scope, out)
            return other(scope, out)

        return choose
    if isinstance(node, For):
        return _looper(node)
    if isinstance(node, Assign):
        value, path = _value(node.value), node.path

        def assign(scope, out):
            if len(path) == 1:
                scope[path[0]] = value(scope)
            elif isinstance(scope.get(path[0]), dict):
                scope[path[0]][path[1]] = value(scope)
            else:
                raise TemplateError(f"{path[0]} is no namespace")

        return assign
    if isinstance(node, Generation):
        inner = _writer(node.body)

        def mark(scope, out):
            begin = out.length
            inner(scope, out)
            out.spans.append((begin, out.length))

        return mark
    value = _value(node)
    return lambda scope, out: out.add(_text(value(scope)))


class Template:
    """render(**values) -> (text, spans of generation blocks in code points). trim_blocks takes the line break after a block off,
    lstrip_blocks the white space before one that begins a line, as published chat templates expect."""

    def __init__(self, source: str, trim_blocks: bool = False, lstrip_blocks: bool = False):
        self.tree = parse(source, trim_blocks, lstrip_blocks)
        self._write = _writer(self.tree)

    def render(self, **values) -> tuple[str, list[tuple[int, int]]]:
        out = _Out()
        self._write(dict(values), out)
        return "".join(out.parts), out.spans
