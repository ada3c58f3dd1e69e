"""Java sources as rows: one pass of a tokenizer and a declaration scanner over each file, on the executors.

parse_sources() gives tagged rows of one schema; what each kind holds stands beside its name below. The scanner reads
declarations and call expressions only. A file that does not parse gives an error row, and rows marked as fallback: of a
second scan that lets unmatched brackets be, or where that fails too, of patterns. No file stops a job.
"""

from __future__ import annotations

import re
import string
from collections.abc import Collection, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calltrail.functions.text import CONTROL_WORDS
from calltrail.operators.shared import in_slices

#: package: name. import: name, type (type, wildcard, static, static_wildcard). type: cls, type, name (extends), extra
#: (implements), ann. method: cls, mth, type (returns), name (access), extra (parameter types), n (arity), line, end, ann.
#: field: cls, name, type, ann. var: cls, mth, name, type, extra (param, local, for). call: cls, mth, name (text), type
#: (how it was found), pos. site: cls, mth, name (names of a call expression), type (plain, index, cast, new, throw, made),
#: pos; resolution.resolved_calls() makes calls of them. value: cls, mth, name (key), type (variable), extra (annotation). error: name.
#: ann of var, site and call: parameter types of their method, which tell overloads apart. n of a param: its place.
SCHEMA = "path string, kind string, cls string, mth string, name string, type string, extra string, ann string, pos long, n int, line int, end int, fallback boolean"
COLUMNS = tuple(c.split()[0] for c in SCHEMA.split(", "))

_TOKEN = re.compile(
    r"""(?P<comment>/\*.*?(?:\*/|\Z)|//[^\n]*) | (?P<string>"(?:[^"\\\n]|\\.)*") | (?P<char>'(?:[^'\\\n]|\\.)*')
      | (?P<word>[A-Za-z_$][\w$]*) | (?P<number>\d[\w.]*) | (?P<mark>[^\s])""",
    re.VERBOSE | re.DOTALL,
)
#: The same tokens, each with the blanks before it: a run of blanks is one step, and not a failed match a place. The last
#: piece may be blanks alone.
_PIECE = re.compile(r"""(\s*+)([A-Za-z_$][\w$]*|\d[\w.]*|/\*.*?(?:\*/|\Z)|//[^\n]*|"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|[^\s]|\Z)""", re.DOTALL)
_KINDS = dict.fromkeys(string.ascii_letters + "_$", "word") | dict.fromkeys(string.digits, "number") | dict.fromkeys("(){}[];,.=<>:@!&|+-*?%", "mark")
_OPENERS, _CLOSED = frozenset("({["), {")": "(", "}": "{", "]": "["}
_MODIFIERS = frozenset("public private protected static final abstract synchronized native strictfp transient volatile default sealed".split())
_ACCESS = {"public": "Public", "private": "Private", "protected": "Protected"}
_SKIP = frozenset(CONTROL_WORDS) - {"this", "super"}
_PRIMITIVE = frozenset("int long short byte char float double boolean".split())
_KEY = re.compile(r"\$\{\s*([^}:\s]+)[^}]*\}")


@dataclass(slots=True)
class Token:
    text: str
    kind: str
    at: int
    line: int


def _open_angles(tokens: list[Token]) -> bool:
    return sum((t.text == "<") - (t.text == ">") for t in tokens) > 0


@dataclass
class Scope:
    cls: str


def _kind(piece: str) -> str:
    """Kind of a piece that its first character alone does not tell."""
    if len(piece) > 1 and piece[0] in "/\"'":
        return {"/": "comment", '"': "string", "'": "char"}[piece[0]]
    return "number" if piece[0].isdecimal() else "mark"


def pieces(text: str) -> Iterator[tuple[str, str, int, int]]:
    """kind, text, at, line of all tokens, comments too."""
    at, line, known = 0, 1, _KINDS
    for blanks, piece in _PIECE.findall(text):
        if blanks:
            at += len(blanks)
            if "\n" in blanks:
                line += blanks.count("\n")
        if piece:
            kind = known.get(piece[0]) or _kind(piece)
            yield kind, piece, at, line
            at += len(piece)
            if kind in ("comment", "string", "char"):
                line += piece.count("\n")


def tokenize(text: str, comments: bool = False) -> list[Token]:
    return [Token(piece, kind, at, line) for kind, piece, at, line in pieces(text) if comments or kind != "comment"]


def blanked(text: str, literals: bool = True, fill: str = "") -> str:
    """The text without comments, and without string and character literals if asked; fill stands in their place."""
    out, end = [], 0
    for m in _TOKEN.finditer(text):
        if m.lastgroup == "comment" or literals and m.lastgroup in ("string", "char"):
            out += [text[end : m.start()], fill]
            end = m.end()
    return "".join([*out, text[end:]])


def _partners(tokens: list[Token], strict: bool = True) -> dict[int, int]:
    """Where each opening bracket closes. Unmatched ones are an error; else those that close nothing are left alone, and
    what stays open closes with what holds it."""
    out, stack = {}, []
    for i, t in enumerate(tokens):
        if t.text in _OPENERS:
            stack.append(i)
        elif t.text in _CLOSED:
            opener = _CLOSED[t.text]
            if stack and tokens[stack[-1]].text == opener:
                out[stack.pop()] = i
            elif strict:
                raise ValueError(f"unmatched {t.text} in line {t.line}")
            elif any(tokens[k].text == opener for k in stack) and t.text == "}":
                while tokens[stack[-1]].text != opener:
                    out[stack.pop()] = i - 1
                out[stack.pop()] = i
    if stack and strict:
        raise ValueError(f"unmatched {tokens[stack[-1]].text} in line {tokens[stack[-1]].line}")
    return out | dict.fromkeys(stack, len(tokens) - 1)


def _joined(tokens: list[Token]) -> str:
    return "".join(f" {t.text}" if k and t.kind == "word" and tokens[k - 1].kind == "word" else t.text for k, t in enumerate(tokens))


class Scanner:
    def __init__(self, path: str, text: str, accept_new_types: bool = True):
        self.path, self.text = path, text
        self.accept_new_types = accept_new_types
        self.tokens = tokenize(text)
        self.rows: list[dict] = []
        self.fallback = False

    def add(self, kind: str, **values) -> None:
        self.rows.append({"path": self.path, "kind": kind, "fallback": self.fallback, **values})

    def run(self) -> list[dict]:
        try:
            return self._scan(strict=True)
        except Exception as e:  # whatever a file holds, it is that file's row
            error = {"path": self.path, "kind": "error", "name": f"{type(e).__name__}: {e}", "fallback": True}
        self.fallback = True
        try:
            return [error, *self._scan(strict=False)]
        except Exception:
            self.rows = []
            self._patterns()
            return [error, *self.rows]

    def _scan(self, strict: bool) -> list[dict]:
        self.rows, self.skipped, self.anonymous = [], [], 0
        self.partner = _partners(self.tokens, strict)
        self._unit()
        return self.rows

    def _until(self, i: int, *texts: str, stop: int | None = None) -> int:
        """The next token with one of the texts."""
        for k in range(i, len(self.tokens) if stop is None else stop):
            if self.tokens[k].text in texts:
                return k
        raise ValueError(f"no {' or '.join(texts)} after line {self.tokens[min(i, len(self.tokens) - 1)].line}")

    # Each of these takes a place among the tokens and returns the next one.

    def _unit(self) -> None:
        t, i = self.tokens, 0
        while i < len(t) and t[i].text in ("package", "import"):
            end = self._until(i, ";")
            words = t[i + 1 : end]
            static = bool(words) and words[0].text == "static"
            name = "".join(x.text for x in words[static:])
            if t[i].text == "package":
                self.add("package", name=name)
            else:
                star = name.endswith(".*")
                self.add("import", name=name.removesuffix(".*"), type=("static" if static else "") + ("_" if static and star else "") + ("wildcard" if star else "" if static else "type"))
            i = end + 1
        self._members(i, len(t), None)

    def _annotations(self, i: int) -> tuple[int, list[str]]:
        t, out = self.tokens, []
        while i + 1 < len(t) and t[i].text == "@" and t[i + 1].text != "interface":
            end = i + 2
            while end + 1 < len(t) and t[end].text == ".":
                end += 2
            if end < len(t) and t[end].text == "(":
                end = self.partner[end] + 1
            out.append(self.text[t[i].at : t[end - 1].at + len(t[end - 1].text)])
            i = end
        return i, out

    def _members(self, i: int, stop: int, scope: Scope | None) -> None:
        t = self.tokens
        late = []
        while i < stop:
            begin = i
            annotations, access = [], None
            while i < stop and (t[i].text == "@" and i + 1 < stop and t[i + 1].text != "interface" or t[i].text in _MODIFIERS):
                if t[i].text == "@":
                    i, found = self._annotations(i)
                    annotations += found
                else:
                    access = _ACCESS.get(t[i].text, access)
                    i += 1
            if i >= stop:
                break
            if t[i].text in ("class", "interface", "enum") or t[i].text == "@":
                i = self._type(i, annotations)
            elif t[i].text == "{":
                i = self.partner[i] + 1  # initializer
            elif t[i].text in (";", ","):
                i += 1
            elif scope is None:
                i += 1
            else:
                i, body = self._member(begin, i, stop, scope, annotations, access)
                if body:
                    late.append(body)
        for args in late:  # fields may stand behind the methods that use them
            self._body(*args)

    def _type(self, i: int, annotations: list[str]) -> int:
        t = self.tokens
        if t[i].text == "@":
            i += 1
        kind, name = t[i].text, t[i + 1].text
        open_ = self._until(i, "{")
        head, extends, implements, into = t[i + 2 : open_], [], [], None
        for x in head:
            if x.text in ("extends", "implements"):
                into = extends if x.text == "extends" else implements
            elif into is not None:
                into.append(x)
        label = "class_implements_interface" if kind == "class" and implements else kind
        self.add("type", cls=name, type=label, name=_joined(extends) or None, extra=_joined(implements).replace(",", ";") or None, ann=";".join(annotations) or None, pos=t[i].at, line=t[i].line)
        start = open_ + 1
        if kind == "enum":
            depth_end = self.partner[open_]
            while start < depth_end and t[start].text != ";":
                start = self.partner[start] + 1 if start in self.partner else start + 1
        self._members(start, self.partner[open_], Scope(name))
        return self.partner[open_] + 1

    def _member(self, begin: int, i: int, stop: int, scope: Scope, annotations: list[str], access: str | None) -> tuple[int, tuple | None]:
        t, k, angle = self.tokens, i, 0
        while k < stop:
            x = t[k].text
            if x == "<":
                angle += 1
            elif x == ">":
                angle -= 1
            elif angle <= 0 and x in ("(", ";", "=", "{"):
                break
            k += 1
        if k < stop and t[k].text == "(":
            name, returns = t[k - 1].text, t[i : k - 1]
            if returns and returns[0].text == "<":  # type parameters of the method
                depth, r = 0, 0
                for r, y in enumerate(returns):
                    depth += (y.text == "<") - (y.text == ">")
                    if not depth:
                        break
                returns = returns[r + 1 :]
            close = self.partner[k]
            params = self._params(k + 1, close)
            end = self._until(close, "{", ";", stop=stop)
            last = self.partner[end] if t[end].text == "{" else end
            self.add("method", cls=scope.cls, mth=name, type=_joined(returns) or "constructor", name=access or "Default", extra=";".join(p for p, _ in params), n=len(params), pos=t[begin].at, line=t[begin].line, end=t[last].line, ann=";".join(annotations) or None)
            for place, (kind, v) in enumerate(params):
                self.add("var", cls=scope.cls, mth=name, name=v, type=kind, extra="param", ann=";".join(p for p, _ in params), pos=t[k].at, n=place)
            return last + 1, (scope, name, params, end + 1, last) if t[end].text == "{" else None
        if k >= stop:
            return stop, None
        kind = _joined(t[i : k - 1])
        if "," in kind.split(">")[-1]:  # int a, b = 1: the type ends before the first name
            first = next(x for x in range(i, k) if t[x].text == "," and not _open_angles(t[i:x]))
            kind, k = _joined(t[i : first - 1]), first
        end = k
        while end < stop and t[end].text != ";":
            end = self.partner[end] + 1 if end in self.partner else end + 1
        for name in [t[k - 1].text, *self._more_names(k, end)]:
            self.add("field", cls=scope.cls, name=name, type=kind, ann=";".join(annotations) or None, pos=t[i].at, line=t[i].line)
            for a in annotations:
                if a.startswith("@Value"):
                    for key in _KEY.findall(a):
                        self.add("value", cls=scope.cls, name=key, type=name, extra=a, pos=t[begin].at)
        return end + 1, None

    def _more_names(self, k: int, end: int) -> list[str]:
        """Names declared behind the first one, before its semicolon; commas in brackets and type arguments part nothing."""
        t, out, angle = self.tokens, [], 0
        while k < end:
            if k in self.partner:
                k = self.partner[k] + 1
                continue
            angle += (t[k].text == "<") - (t[k].text == ">")
            if t[k].text == "," and angle <= 0 and k + 1 <= end and t[k + 1].kind == "word" and (k + 2 >= end or t[k + 2].text in ("=", ",", "[")):
                out.append(t[k + 1].text)
            k += 1
        return out

    def _params(self, i: int, stop: int) -> list[tuple[str, str]]:
        """(type, name) of each parameter."""
        t, out, angle, part = self.tokens, [], 0, []
        for k in range(i, stop + 1):
            x = t[k].text
            angle += (x == "<") - (x == ">")
            if k == stop or x == "," and angle <= 0:
                words = self._plain(part)
                if len(words) >= 2:
                    name = words[-1].text
                    out.append((_joined(words[:-1]).replace("...", "[]"), name))
                part = []
            else:
                part.append(k)
        return out

    def _plain(self, places: list[int]) -> list[Token]:
        """Tokens without annotations and final."""
        out, k, places_ = [], 0, places
        while k < len(places_):
            i = places_[k]
            if self.tokens[i].text == "@":
                end, _ = self._annotations(i)
                k += end - i
            else:
                if self.tokens[i].text != "final":
                    out.append(self.tokens[i])
                k += 1
        return out

    # --- bodies ---

    def _body(self, scope: Scope, method: str, params: list[tuple[str, str]], i: int, stop: int) -> None:
        inner = self._anonymous(scope, i, stop)
        self.signature = ";".join(kind for kind, _ in params)
        self._locals(scope, method, i, stop, inner)
        for k in self._before(i, stop, "(", "[", ".", "<"):
            if k not in inner:
                self._site(scope, method, k, stop)

    def _before(self, i: int, stop: int, *texts: str) -> list[int]:
        """Places of tokens that stand before one of the texts; nothing else there can begin what is looked for."""
        return [k for k, x in enumerate(self.tokens[i + 1 : stop], i) if x.text in texts]

    def _anonymous(self, scope: Scope, i: int, stop: int) -> set[int]:
        """Bodies of anonymous classes as types of their own; returns the tokens in them."""
        t, inner = self.tokens, set()
        for k in self._before(i - 1, stop, "new"):
            k += 1
            if k in inner or k + 1 >= stop or t[k + 1].kind != "word":
                continue
            try:
                open_ = self._until(k, "(", "[", ";", "{", stop=stop)
            except ValueError:
                continue
            body = self.partner.get(open_, stop) + 1
            if t[open_].text == "(" and body < stop and t[body].text == "{" and body in self.partner:
                self.anonymous += 1
                name = f"{scope.cls}${self.anonymous}"
                self.add("type", cls=name, type="anonymous", name=t[k + 1].text, pos=t[k].at, line=t[k].line)
                inner |= set(range(body, self.partner[body] + 1))
                self._members(body + 1, self.partner[body], Scope(name))
        return inner

    def _locals(self, scope: Scope, method: str, i: int, stop: int, inner: set[int]) -> None:
        """Declared variables: Type name followed by "=", ";", or ":" of a loop; a constructor call names the type."""
        t = self.tokens
        for k in self._before(i + 1, stop, "=", ";", ":", ","):
            if k in inner or t[k].kind != "word" or t[k].text in CONTROL_WORDS:
                continue
            j, angle = k - 1, 0
            while j >= i and (angle or t[j].kind == "word" and (t[j].text not in _SKIP or t[j].text in _PRIMITIVE) or t[j].text in (">", ".", "]", "[")):
                angle += (t[j].text == ">") - (t[j].text == "<")
                j -= 1
                if not angle and j >= i and t[j].kind == "word" and t[j + 1].kind == "word":
                    break
            kind = _joined(t[j + 1 : k])
            if not kind or not re.match(r"[A-Za-z_]", kind) or kind in ("final", "return", "throw", "else") or t[k - 1].text == ".":
                continue
            loop = t[k + 1].text == ":"
            if t[k + 1].text == ":" and t[j].text != "(" and (j < i or t[j - 1].text != "("):
                continue
            if t[k + 1].text == "," and (j >= i and t[j].text not in ("{", "}", ";")):
                continue  # an argument, or a part of a type
            declared = kind
            if self.accept_new_types and t[k + 1].text == "=" and k + 3 < stop and t[k + 2].text == "new" and t[k + 3].kind == "word":
                kind = t[k + 3].text
            end = k + 1
            while end < stop and t[end].text != ";" and not loop:
                end = self.partner[end] + 1 if end in self.partner else end + 1
            for name, own in [(t[k].text, kind), *((n, declared) for n in (() if loop else self._more_names(k + 1, end)))]:
                self.add("var", cls=scope.cls, mth=method, name=name, type=own, extra="for" if loop else "local", ann=self.signature, pos=t[k].at)

    def _site(self, scope: Scope, method: str, k: int, stop: int) -> None:
        """The call expression that starts at token k, if one does: its names in a row, called ones with "()"."""
        t = self.tokens
        if t[k].text == "(" and k + 1 < stop and t[k + 1].text == "(":  # ((Type) x).call(
            cast, close = self.partner[k + 1], self.partner[k]
            typed = all(x.kind == "word" or x.text in (".", "<", ">", ",", "[", "]") for x in t[k + 2 : cast]) and t[k + 2].kind == "word"
            if typed and t[cast + 1].kind == "word" and close + 3 < stop and t[close + 1].text == "." and t[close + 3].text == "(":
                names, _ = self._names(close + 2, stop)
                self._found(scope, method, [re.sub(r"<.*>", "", _joined(t[k + 2 : cast])), *names], "cast", t[k].at)
            return
        if t[k].kind != "word" or t[k - 1].text == "." or t[k].text in _SKIP:
            return
        if t[k - 1].text == "new":
            if k + 1 < stop and t[k + 1].text in ("(", "<"):
                self._found(scope, method, [t[k].text], "throw" if t[k - 2].text == "throw" else "new", t[k].at)
                end = self._until(k, "(", stop=stop)
                after = self.partner[end] + 1
                if after + 1 < stop and t[after].text == "." and t[after + 1].kind == "word":  # new X(..).call(
                    names, called = self._names(after + 1, stop)
                    if called:
                        self._found(scope, method, [t[k].text, *names], "made", t[k].at)
            return
        j = k + 1
        while j < stop and t[j].text == "[":  # a[0].call(
            j = self.partner[j] + 1
        if j > k + 1:
            names, called = self._names(j + 1, stop) if j + 1 < stop and t[j].text == "." else ([], False)
            names = [t[k].text, *names]
        else:
            names, called = self._names(k, stop)
        if called:
            self._found(scope, method, names, "index" if j > k + 1 else "plain", t[k].at)

    def _names(self, j: int, stop: int) -> tuple[list[str], bool]:
        """Names joined by dots from token j to the last one that is called, and whether one is."""
        t, out, last = self.tokens, [], 0
        while j < stop and t[j].kind == "word":
            out.append(t[j].text)
            j += 1
            if j < stop and t[j].text == "(":
                out[-1] += "()"
                last, j = len(out), self.partner[j] + 1
            if j + 1 < stop and t[j].text == ".":
                j += 1
            else:
                break
        return out[:last], last > 0

    def _found(self, scope: Scope, method: str, names: list[str], how: str, at: int) -> None:
        self.add("site", cls=scope.cls, mth=method, name=".".join(names), type=how, ann=self.signature, pos=at)

    # --- files that do not scan at all ---

    def _patterns(self) -> None:
        """Types, members, variables and calls by pattern, over the text without comments and literals."""
        plain = blanked(self.text, True, " ")
        marks = [(m.start(), "type", m[2], m[1]) for m in re.finditer(r"\b(class|interface|enum)\s+([A-Za-z_]\w*)", plain)]
        marks += [(m.start(), "method", m[2], m[1]) for m in re.finditer(r"\b([A-Za-z_][\w<>\[\].]*)\s+([A-Za-z_]\w*)\s*\([^(){};]*\)\s*(?:throws\s+[\w.,\s]+)?\{", plain) if (m[1] not in _SKIP or m[1] in _PRIMITIVE or m[1] == "void") and m[2] not in CONTROL_WORDS]
        cls = mth = None
        found = [(m.start(), "new", m[2], m[1]) for m in re.finditer(r"\b(throw\s+)?new\s+([A-Z]\w*)\s*[(<]", plain)]
        found += [(m.start(), "var", m[2], m[1]) for m in re.finditer(r"\b([A-Z][\w<>\[\].]*)\s+([a-z_]\w*)\s*[=;:]", plain)]
        found += [(m.start(), "call", m[0], None) for m in re.finditer(r"\b[A-Za-z_]\w*(?:\s*\.\s*[A-Za-z_]\w*)+\s*\(", plain)]
        for at, kind, name, extra in sorted(marks + found, key=lambda x: (x[0], x[1])):
            if kind == "type":
                cls, mth = name, None
                self.add("type", cls=name, type=extra, pos=at)
            elif kind == "method":
                mth = name
                self.add("method", cls=cls, mth=name, type=extra, pos=at)
            elif kind == "var":
                self.add("var", cls=cls, mth=mth, name=name, type=extra, extra="local", pos=at)
            elif kind == "new":
                self.add("call", cls=cls, mth=mth, name=f"{name}.{name}()", type="throw" if extra else "ctor", pos=at)
            elif (parts := re.findall(r"\w+", name))[0] not in CONTROL_WORDS:
                self.add("call", cls=cls, mth=mth, name=f"{'.'.join(parts)}()", type="qualified", pos=at)


def code_tokens(text: str) -> list[dict]:
    """Brackets, declarations and call sites in the order of the text: kind (open, close, decl, call), name, recv, pos, line.

    A name before "(" is a declaration where a type stands before it and a body, "throws" or ";" behind its brackets.
    """
    t, out = tokenize(text), []
    partner = _partners(t, strict=False)
    for k, x in enumerate(t):
        if x.text in ("{", "}"):
            out.append({"kind": "open" if x.text == "{" else "close", "name": x.text, "pos": x.at, "line": x.line})
        if x.kind != "word" or k + 1 >= len(t) or t[k + 1].text != "(" or x.text in _SKIP or x.text in ("this", "super"):
            continue
        before = t[k - 1].text if k else ""
        after = t[partner[k + 1] + 1].text if partner[k + 1] + 1 < len(t) else ""
        if before == "@":
            continue
        typed = k > 0 and (t[k - 1].kind == "word" and before not in ("new", "return", "else", "throw", "case") or before in (">", "]"))
        if typed and after in ("{", "throws", ";"):
            out.append({"kind": "decl", "name": x.text, "pos": x.at, "line": x.line})
        else:
            recv = t[k - 2].text if before == "." and k > 1 and t[k - 2].kind == "word" else None
            out.append({"kind": "call", "name": x.text, "recv": recv, "pos": x.at, "line": x.line})
    return out


#: Bytes of texts that a worker has as rows at once: tokens and rows take some fifty times their text.
SLICE = 1 << 20


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[str, str]]]:
    """(path, text) of some files at a time; null texts go."""
    for batch in in_slices(batches, SLICE):
        yield [(p, text) for p, text in zip(*(c.to_pylist() for c in batch.columns), strict=True) if text is not None]


def scan_tokens(files: DataFrame, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """path, kind, name, recv, pos, line of all files: code_tokens() in one narrow stage. Null texts have no rows."""
    columns = (("path", pa.string()), ("kind", pa.string()), ("name", pa.string()), ("recv", pa.string()), ("pos", pa.int64()), ("line", pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _texts(batches):
            rows = [{"path": p, **r} for p, text in texts for r in code_tokens(text)]
            yield pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], k) for c, k in columns], names=[c for c, _ in columns])

    return files.select(F.col(path_col).cast("string"), F.col(text_col).cast("string")).mapInArrow(run, "path string, kind string, name string, recv string, pos long, line int")


def all_tokens(files: DataFrame, path_col: str = "path", text_col: str = "text", marks: str | None = None) -> DataFrame:
    """path, kind (word, number, string, char, mark), text, pos, line: every token but comments, or the asked marks alone,
    so that no other token leaves its worker. Null texts have none."""
    names = ("path", "kind", "text", "pos", "line")
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _texts(batches):
            rows = [(p, *x) for p, text in texts for x in pieces(text) if (x[0] != "comment" if marks is None else x[1] in marks)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=list(names))

    return files.select(F.col(path_col).cast("string"), F.col(text_col).cast("string")).mapInArrow(run, "path string, kind string, text string, pos long, line int")


def rows_to_batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = [pa.int64() if c == "pos" else pa.int32() if c in ("n", "line", "end") else pa.bool_() if c == "fallback" else pa.string() for c in COLUMNS]
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], k) for c, k in zip(COLUMNS, kinds, strict=True)], names=list(COLUMNS))


def parsed(batches: Iterator[pa.RecordBatch], kinds: Collection[str] | None = None, **options) -> Iterator[pa.RecordBatch]:
    """Rows of batches of (path, text), a batch for some files at a time."""
    for texts in _texts(batches):
        yield rows_to_batch([r for path, text in texts for r in Scanner(path, text, **options).run() if kinds is None or r["kind"] in kinds])


def parse_sources(files: DataFrame, path_col: str = "path", text_col: str = "text", **options) -> DataFrame:
    """Rows of all files: one narrow stage. Null texts have no rows. options: kinds, where rows of others need not leave
    their worker (files are scanned whole for all that), and behaviour flags of the scanner."""
    return files.select(F.col(path_col).cast("string"), F.col(text_col).cast("string")).mapInArrow(lambda batches: parsed(batches, **options), SCHEMA)
