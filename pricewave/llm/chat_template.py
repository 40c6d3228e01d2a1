"""Chat formatting by a small sandboxed template language.

A template is cut into text, ``{{ expression }}``, ``{% tag %}`` and
``{# comment #}``, parsed into a syntax tree, constant parts folded, and compiled
into Python closures. A ``-`` inside a delimiter strips the white space beside
it. Names reach only the values passed in and those set by ``{% set %}``, which
last to the end of the loop's turn they are set in; missing ones are none. There
are no attributes beyond mapping keys and no calls beyond the listed filters and
tests. Text between ``{% generation %}`` and ``{% endgeneration %}`` is under the
loss mask. Whatever a template asks of values that cannot give it, such as the
sum of a number and a text, is a TemplateError.
"""

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

_QUOTED = r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\""
_PARTS = re.compile(rf"(\{{#.*?#\}}|\{{\{{(?:{_QUOTED}|.)*?\}}\}}|\{{%(?:{_QUOTED}|.)*?%\}})", re.S)
_TOKEN = re.compile(r"\s*(?:(\d+)|('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|([A-Za-z_]\w*)|(==|!=|<=|>=|[-+*%~|.:()\[\]<>]))")
_ESCAPES = {"n": "\n", "t": "\t"}

#: Strings that mark structure, as patterns: opening bracket, backslashes, the rest.
_CONTROL = re.compile(r"([<\[])(\\*)(/?s>|/?INST\])")
_GUARDED = re.compile(r"([<\[])\\(\\*)(/?s>|/?INST\])")


def guard(text: str) -> str:
    """Add one backslash inside every control string, so that the text holds none; unguard() takes it out."""
    return _CONTROL.sub(r"\1\\\2\3", text)


def unguard(text: str) -> str:
    return _GUARDED.sub(r"\1\2\3", text)


def one_line(text: str) -> str:
    """Backslashes and line feeds written as two characters."""
    return text.replace("\\", "\\\\").replace("\n", "\\n")


def many_lines(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text)


class TemplateError(ValueError):
    pass


def _checked(what, call):
    """call, with values that it cannot take as a TemplateError."""

    def run(*args):
        try:
            return call(*args)
        except (TypeError, AttributeError, ValueError, IndexError, ZeroDivisionError) as e:
            raise TemplateError(f"{what}: {e}") from None

    return run


FILTERS = {name: _checked(name, f) for name, f in (("guard", guard), ("line", one_line), ("trim", str.strip), ("upper", str.upper), ("lower", str.lower), ("length", len), ("string", str), ("first", lambda x: x[0]), ("last", lambda x: x[-1]))}
TESTS = {
    "defined": lambda x: x is not None, "none": lambda x: x is None, "string": lambda x: isinstance(x, str), "number": lambda x: isinstance(x, (int, float)) and not isinstance(x, bool),
    "mapping": lambda x: isinstance(x, dict), "true": lambda x: x is True, "false": lambda x: x is False,
}


class _Expression:
    """Recursive descent over one expression; nodes are tuples (kind, ...)."""

    def __init__(self, source: str):
        self.items, at, source = [], 0, source.rstrip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.items.append(m.groups())
            at = m.end()
        self.at = 0

    def peek(self, *ops):
        if self.at >= len(self.items):
            return None
        number, text, name, op = self.items[self.at]
        return (op or name) if (op or name) in ops and text is None else None

    def take(self, *ops):
        found = self.peek(*ops)
        if found:
            self.at += 1
        return found

    def need(self, op):
        if not self.take(op):
            raise TemplateError(f"expected {op!r}")

    def parse(self):
        node = self.chosen()
        if self.at != len(self.items):
            raise TemplateError("text after the expression")
        return node

    def chosen(self):
        """a if test else b; without else none."""
        node = self.either()
        if self.take("if"):
            test = self.either()
            node = ("choose", test, node, self.chosen() if self.take("else") else ("value", None))
        return node

    def either(self):
        node = self.both()
        while self.take("or"):
            node = ("or", node, self.both())
        return node

    def both(self):
        node = self.negated()
        while self.take("and"):
            node = ("and", node, self.negated())
        return node

    def negated(self):
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self):
        node = self.joined()
        while op := self.take("==", "!=", "<", ">", "<=", ">=", "in", "not", "is"):
            if op == "not":
                self.need("in")
                node = ("not", ("in", node, self.joined()))
            elif op == "is":
                wrong = self.take("not")
                name = self.items[self.at][2] if self.at < len(self.items) else None
                if name not in TESTS:
                    raise TemplateError(f"no test {name!r}")
                self.at += 1
                node = ("test", name, node)
                node = ("not", node) if wrong else node
            else:
                node = (op, node, self.joined())
        return node

    def joined(self):
        """Text joined by ~, which binds looser than + and -."""
        node = self.summed()
        while op := self.take("~"):
            node = (op, node, self.summed())
        return node

    def summed(self):
        node = self.multiplied()
        while op := self.take("+", "-"):
            node = (op, node, self.multiplied())
        return node

    def multiplied(self):
        node = self.filtered()
        while op := self.take("*", "%"):
            node = (op, node, self.filtered())
        return node

    def filtered(self):
        node = self.reached()
        while self.take("|"):
            name = self.items[self.at][2] if self.at < len(self.items) else None
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            node = ("filter", name, node)
        return node

    def reached(self):
        node = self.single()
        while op := self.take(".", "["):
            if op == ".":
                name = self.items[self.at][2] if self.at < len(self.items) else None
                if not name:
                    raise TemplateError("expected a key after '.'")
                self.at += 1
                node = ("key", node, ("value", name))
            else:
                low = None if self.peek(":") else self.either()
                if self.take(":"):
                    high = None if self.peek("]") else self.either()
                    node = ("slice", node, low or ("value", None), high or ("value", None))
                else:
                    node = ("key", node, low)
                self.need("]")
        return node

    def single(self):
        if self.take("("):
            node = self.chosen()
            self.need(")")
            return node
        if self.take("-"):
            return ("-", ("value", 0), self.reached())
        if self.at >= len(self.items):
            raise TemplateError("expression ends early")
        number, text, name, op = self.items[self.at]
        self.at += 1
        if number:
            return ("value", int(number))
        if text:
            return ("value", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), text[1:-1]))
        if name and name.lower() in _NAMED:
            return ("value", _NAMED[name.lower()])
        if name:
            return ("name", name)
        raise TemplateError(f"unexpected {op!r}")


_NAMED = {"true": True, "false": False, "none": None}


def _pieces(source: str) -> list[str]:
    """Texts, and parts without the signs that strip the white space beside them."""
    out = _PARTS.split(source)
    for k in range(1, len(out), 2):
        if out[k][2:3] == "-":
            out[k] = out[k][:2] + out[k][3:]
            out[k - 1] = out[k - 1].rstrip()
        if out[k][-3:-2] == "-" and len(out[k]) > 4:
            out[k] = out[k][:-3] + out[k][-2:]
            out[k + 1] = out[k + 1].lstrip()
    return [p for k, p in enumerate(out) if p and not (k % 2 and p.startswith("{#"))]


def parse(source: str) -> list:
    """Syntax tree: a list of ("text", s), ("print", e), ("set", name, e), ("for", name, e, body), ("if", [(e, body)...], orelse), ("generation", body)."""
    pieces = _pieces(source)
    body, at = _block(pieces, 0, ())
    if at != len(pieces):
        raise TemplateError(f"unexpected {pieces[at]!r}")
    return body


def _tag(piece):
    return piece[2:-2].strip() if piece.startswith("{%") else None


def _block(pieces, at, until):
    out = []
    while at < len(pieces):
        piece, tag = pieces[at], _tag(pieces[at])
        if tag is None:
            out.append(("print", _Expression(piece[2:-2]).parse()) if piece.startswith("{{") else ("text", piece))
            at += 1
            continue
        word = tag.split(None, 1)[0] if tag else ""
        if word in until:
            return out, at
        if word == "for":
            m = re.fullmatch(r"for\s+([A-Za-z]\w*)\s+in\s+(.+)", tag, re.S)
            if not m:
                raise TemplateError(f"cannot read {tag!r}")
            body, at = _closed(pieces, at, "endfor")
            out.append(("for", m[1], _Expression(m[2]).parse(), body))
        elif word == "set":
            m = re.fullmatch(r"set\s+([A-Za-z_]\w*)\s*=(?!=)\s*(.+)", tag, re.S)
            if not m:
                raise TemplateError(f"cannot read {tag!r}")
            out.append(("set", m[1], _Expression(m[2]).parse()))
            at += 1
        elif word == "generation":
            body, at = _closed(pieces, at, "endgeneration")
            out.append(("generation", body))
        elif word == "if":
            arms, other = [], []
            while True:
                test = _Expression((tag.split(None, 1) + [""])[1]).parse()
                body, at = _block(pieces, at + 1, ("elif", "else", "endif"))
                arms.append((test, body))
                tag = _tag(pieces[at]) if at < len(pieces) else ""
                if tag == "else":
                    other, at = _block(pieces, at + 1, ("endif",))
                    tag = "endif" if at < len(pieces) else ""
                if tag == "endif":
                    break
                if not tag or not tag.startswith("elif"):
                    raise TemplateError("if without endif")
            out.append(("if", arms, other))
            at += 1
        else:
            raise TemplateError(f"no tag {word!r}")
    if until:
        raise TemplateError(f"expected {until[-1]}")
    return out, at


def _closed(pieces, at, end):
    body, at = _block(pieces, at + 1, (end,))
    return body, at + 1


_BINARY = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b, "in": lambda a, b: a in b,
    "+": lambda a, b: a + b, "-": lambda a, b: a - b, "*": lambda a, b: _number(a) * _number(b), "%": lambda a, b: _number(a) % b, "~": lambda a, b: f"{_shown(a)}{_shown(b)}",
}
_BINARY = {op: _checked(op, call) for op, call in _BINARY.items()}


def _shown(value) -> str:
    return "" if value is None else str(value)


def _number(value):
    """Texts are neither repeated nor taken as formats."""
    if isinstance(value, (str, list, tuple)):
        raise TypeError("a number is needed")
    return value


def _slice(value, low, high):
    if not isinstance(value, (str, list, tuple)):
        raise TypeError("only texts and lists have parts")
    return value[low:high]


_slice = _checked("slice", _slice)


def fold_expression(node):
    """Constant subexpressions become values."""
    kind = node[0]
    if kind in ("value", "name"):
        return node
    if kind == "filter":
        inner = fold_expression(node[2])
        return ("value", FILTERS[node[1]](inner[1])) if inner[0] == "value" else ("filter", node[1], inner)
    if kind == "test":
        inner = fold_expression(node[2])
        return ("value", TESTS[node[1]](inner[1])) if inner[0] == "value" else ("test", node[1], inner)
    args = [fold_expression(a) for a in node[1:]]
    if kind in ("and", "or") and args[0][0] == "value":
        return args[1] if bool(args[0][1]) == (kind == "and") else args[0]
    if kind == "choose" and args[0][0] == "value":
        return args[1] if args[0][1] else args[2]
    if kind == "slice" and all(a[0] == "value" for a in args):
        return ("value", _slice(*(a[1] for a in args)))
    if kind == "not" and args[0][0] == "value":
        return ("value", not args[0][1])
    if kind in _BINARY and args[0][0] == args[1][0] == "value":
        return ("value", _BINARY[kind](args[0][1], args[1][1]))
    return (kind, *args)


def fold(body: list) -> list:
    """Fold constants: printed values become text, decided ifs their arm, and neighbouring texts one text."""
    out: list = []

    def add(node):
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        elif node != ("text", ""):
            out.append(node)

    for node in body:
        kind = node[0]
        if kind == "print":
            e = fold_expression(node[1])
            add(("text", _shown(e[1])) if e[0] == "value" else ("print", e))
        elif kind == "set":
            add(("set", node[1], fold_expression(node[2])))
        elif kind == "for":
            add(("for", node[1], fold_expression(node[2]), fold(node[3])))
        elif kind == "generation":
            add(("generation", fold(node[1])))
        elif kind == "if":
            arms, other = [], fold(node[2])
            for test, inner in node[1]:
                test = fold_expression(test)
                if test[0] != "value":
                    arms.append((test, fold(inner)))
                elif test[1]:
                    other = fold(inner)
                    break
            if arms:
                add(("if", arms, other))
            else:
                for inner in other:
                    add(inner)
        else:
            add(node)
    return out


def _expression(node):
    kind = node[0]
    if kind == "value":
        value = node[1]
        return lambda scope: value
    if kind == "name":
        name = node[1]
        return lambda scope: scope.get(name)
    if kind in ("filter", "test"):
        call, inner = (FILTERS if kind == "filter" else TESTS)[node[1]], _expression(node[2])
        return lambda scope: call(inner(scope))
    args = [_expression(a) for a in node[1:]]
    if kind == "key":
        held, key = args

        def get(scope):
            value, k = held(scope), key(scope)
            if isinstance(value, dict):
                return value.get(k)
            if isinstance(value, (list, tuple, str)) and isinstance(k, int):
                return value[k] if -len(value) <= k < len(value) else None
            return None

        return get
    if kind == "and":
        return lambda scope: args[0](scope) and args[1](scope)
    if kind == "or":
        return lambda scope: args[0](scope) or args[1](scope)
    if kind == "not":
        return lambda scope: not args[0](scope)
    if kind == "choose":
        return lambda scope: args[1](scope) if args[0](scope) else args[2](scope)
    if kind == "slice":
        return lambda scope: _slice(*(a(scope) for a in args))
    call = _BINARY[kind]
    return lambda scope: call(args[0](scope), args[1](scope))


def _body(body):
    """Closure(scope, emit, masked): emits the body's text; masked tells whether it is under the loss mask."""
    steps = [_step(n) for n in body]

    def run(scope, emit, masked):
        for step in steps:
            step(scope, emit, masked)

    return run


def _step(node):
    kind = node[0]
    if kind == "text":
        text = node[1]
        return lambda scope, emit, masked: emit(text, masked)
    if kind == "print":
        value = _expression(node[1])

        def show(scope, emit, masked):
            emit(_shown(value(scope)), masked)

        return show
    if kind == "set":
        given = _expression(node[2])
        return lambda scope, emit, masked: scope.__setitem__(node[1], given(scope))
    if kind == "generation":
        inner = _body(node[1])
        return lambda scope, emit, masked: inner(scope, emit, True)
    if kind == "if":
        arms, other = [(_expression(t), _body(b)) for t, b in node[1]], _body(node[2])

        def choose(scope, emit, masked):
            for test, inner in arms:
                if test(scope):
                    return inner(scope, emit, masked)
            return other(scope, emit, masked)

        return choose
    name, items, inner = node[1], _expression(node[2]), _body(node[3])

    def loop(scope, emit, masked):
        """The items may be any iterable: one is held ahead, to know the last."""
        source = _checked("for", iter)(items(scope) or ())
        item = next(source, _END)
        index = 0
        while item is not _END:
            ahead = next(source, _END)
            inner({**scope, name: item, "loop": {"index": index + 1, "index0": index, "first": index == 0, "last": ahead is _END}}, emit, masked)
            item, index = ahead, index + 1

    return loop


_END = object()


def compile_template(source: str):
    """render(emit, **names): emit(text, masked) is called for each stretch in order."""
    run = _body(fold(parse(source)))
    return lambda emit, **names: run(dict(names), emit, False)


TEMPLATE = (
    "{% for m in messages %}{{ '<s>' }}{{ m.role | line | guard }}\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | guard }}{% endgeneration %}"
    "{% else %}[INST] {{ m.text | guard }} [/INST]{% endif %}{{ '</s>' }}{% endfor %}"
)

_TURN = re.compile(r"<s>([^\n]*)\n(.*?)</s>", re.S)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of text formatted with TEMPLATE."""
    out = []
    for role, body in _TURN.findall(formatted):
        role = many_lines(unguard(role))
        body = body if role == "assistant" else body[len("[INST] ") : -len(" [/INST]")]
        out.append((role, unguard(body)))
    return out


def format_chats(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """One row per conversation: conv_id, formatted, spans (start, end of each stretch under the loss mask, in code points).

    Turns are taken in the order of turn, ties by role and text, null turns
    first; null roles and texts are empty. Rows whose conv_id is null are each a
    conversation of their own, so they never meet in one group. Repeated rows
    are repeated turns. An empty table gives no rows. A conversation is the unit
    of work: its turns must fit a task, as the formatted text must fit a value.
    """
    t = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    pack = F.struct("turn", "role", "text")
    known = t.where("conv_id is not null").groupBy("conv_id").agg(F.array_sort(F.collect_list(pack)).alias("turns"))
    alone = t.where("conv_id is null").select("conv_id", F.array(pack).alias("turns"))
    schema = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    def run(batches):
        render = compile_template(template)
        for batch in batches:
            rows = []
            for conv, said in zip(batch.column("conv_id").to_pylist(), batch.column("turns").to_pylist()):
                parts, spans, at = [], [], 0

                def emit(text, masked):
                    nonlocal at
                    parts.append(text)
                    if masked and text:
                        if spans and spans[-1]["end"] == at:
                            spans[-1]["end"] = at + len(text)
                        else:
                            spans.append({"start": at, "end": at + len(text)})
                    at += len(text)

                render(emit, messages=said)
                rows.append((conv, "".join(parts), spans))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    both = known.union(alone).select(F.col("conv_id").cast("long").alias("conv_id"), "turns")
    return both.mapInArrow(run, "conv_id long, formatted string, spans array<struct<start: long, end: long>>")


def digests(formatted: DataFrame) -> DataFrame:
    """Read formatted conversations back: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches):
        for batch in batches:
            rows = []
            for conv, text, spans in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "spans"))):
                turns = read_turns(text)
                loss = "".join(unguard(text[s["start"] : s["end"]]) for s in spans)
                sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
                rows.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(text)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return formatted.mapInArrow(run, ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in schema))
