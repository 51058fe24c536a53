"""Options of a declared table: parsing and validation."""

from __future__ import annotations

import inspect
import json
import os
import warnings
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from ..errors import OptionError

NAMES = ("filename", "sorted", "files_in_order", "use_mmap", "use_threads", "max_open_files", "files_func", "files_func_arg")
#: Words for booleans.
TRUE, FALSE = ("true", "on", "yes", "1"), ("false", "off", "no", "0")


def split_paths(text: str) -> list[str]:
    """Space-separated paths; double quotes hold blanks, a backslash takes the next quote or backslash as it is."""
    out, current, quoted, started = [], [], False, False
    chars = iter(text)
    for c in chars:
        if c == "\\" and quoted:
            n = next(chars, "\\")
            current.append(n if n in '"\\' else c + n)
        elif c == '"':
            quoted, started = not quoted, True
        elif c.isspace() and not quoted:
            if started or current:
                out.append("".join(current))
            current, started = [], False
        else:
            current.append(c)
    if quoted:
        raise OptionError("unterminated quote in filename")
    if started or current:
        out.append("".join(current))
    return [p for p in out if p]


def quote_path(path: str) -> str:
    if path and not any(c.isspace() or c in '"\\' for c in path):
        return path
    return '"' + path.replace("\\", "\\\\").replace('"', '\\"') + '"'


def parse_bool(name: str, value) -> bool:
    word = str(value).strip().lower()
    if word in TRUE:
        return True
    if word in FALSE:
        return False
    raise OptionError(f'invalid value for boolean option "{name}": {value}')


def parse_int(name: str, value) -> int:
    try:
        number = int(str(value).strip())
    except ValueError:
        raise OptionError(f'invalid value for integer option "{name}": {value}') from None
    if not -(2**31) <= number < 2**31:
        raise OptionError(f'value of option "{name}" is out of range: {value}')
    return number


def options_from_json(text) -> dict[str, str]:
    """A flat JSON object of texts; None for no options."""
    if text is None:
        return {}
    try:
        found = json.loads(text) if isinstance(text, str) else text
    except ValueError:
        raise OptionError("invalid input syntax for type json") from None
    if not isinstance(found, dict):
        raise OptionError("options must be a JSON object")
    for k, v in found.items():
        if not isinstance(v, str):
            raise OptionError(f'value of option "{k}" must be a text')
    return dict(found)


def local_path(path: str) -> str | None:
    """The path for local file calls; None for other stores."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    return path if "://" not in path else None


def check_function(name: str, functions: dict[str, Callable]) -> Callable:
    """A registered listing function that takes the JSON argument."""
    f = functions.get(name)
    if f is None:
        raise OptionError(f"function {name}(jsonb) does not exist")
    try:
        inspect.signature(f).bind(None)
    except TypeError:
        raise OptionError(f"function {name}(jsonb) does not exist") from None
    kind = inspect.signature(f).return_annotation
    if kind not in (inspect.Signature.empty, list, "list", list[str], "list[str]"):
        raise OptionError(f"return type of '{name}' is {getattr(kind, '__name__', kind)}; expected list[str]")
    return f


def call_function(name: str, f: Callable, arg) -> list[str]:
    """The paths that a listing function gives; an empty list is an empty table."""
    got = f(arg)
    if got is None:
        raise OptionError(f"function '{name}' returned null")
    if not isinstance(got, (list, tuple)):
        raise OptionError(f"return type of '{name}' is {type(got).__name__}; expected list[str]")
    for p in got:
        if p is None:
            raise OptionError(f"function '{name}' returned a null element")
        if not isinstance(p, str):
            raise OptionError(f"return type of '{name}' is list[{type(p).__name__}]; expected list[str]")
    if not got:
        warnings.warn(f"function '{name}' returned no files", stacklevel=3)
    return list(got)


@dataclass(frozen=True)
class TableOptions:
    filename: tuple[str, ...] = ()
    sorted: tuple[str, ...] = ()
    files_in_order: bool = False
    use_mmap: bool = False
    use_threads: bool = False
    max_open_files: int = 0
    files_func: str | None = None
    files_func_arg: object = None
    raw: dict = field(default_factory=dict, compare=False)

    @staticmethod
    def parse(raw: dict[str, str], functions: dict[str, Callable] | None = None) -> "TableOptions":
        """Validated options. Local files must exist; other stores are asked when the table is read."""
        functions = functions or {}
        out = TableOptions(raw=dict(raw))
        for name, value in raw.items():
            if name == "filename":
                paths = tuple(split_paths(value))
                for p in paths:
                    local = local_path(p)
                    if local is not None and not os.path.exists(local):
                        raise OptionError(f"No such file or directory ('{p}')")
                out = replace(out, filename=paths)
            elif name == "sorted":
                out = replace(out, sorted=tuple(value.split()))
            elif name in ("files_in_order", "use_mmap", "use_threads"):
                out = replace(out, **{name: parse_bool(name, value)})
            elif name == "max_open_files":
                out = replace(out, max_open_files=parse_int(name, value))
            elif name == "files_func":
                check_function(value, functions)
                out = replace(out, files_func=value)
            elif name == "files_func_arg":
                try:
                    out = replace(out, files_func_arg=json.loads(value) if isinstance(value, str) else value)
                except ValueError:
                    raise OptionError("invalid input syntax for type json") from None
            else:
                raise OptionError(f'invalid option "{name}"')
        if not out.filename and not out.files_func:
            raise OptionError("filename or function is required")
        return out

    def files(self, functions: dict[str, Callable]) -> list[str]:
        """Paths of the table now; a listing function is asked each time and goes before filename."""
        if self.files_func:
            return call_function(self.files_func, check_function(self.files_func, functions), self.files_func_arg)
        return list(self.filename)
