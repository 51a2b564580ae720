"""Memos of what the distinct parts of texts come to, within one byte budget for each process."""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import lru_cache
from typing import Any

import pyarrow as pa

#: Bytes that the memo of a process may hold, about; parts that come later are worked out each time.
BUDGET = 96 << 20
#: A dictionary's own share of an entry, about.
ENTRY = 104
#: Characters of a part that is kept. Longer ones rarely repeat: prose without blanks, encoded data.
LONGEST = 64


class Memo(dict):
    """Maps a part to what ``make`` finds for it. The first parts seen stay: frequent ones come early."""

    def __init__(self, make: Callable[[str], Any], budget: int | None = None):
        super().__init__()
        self._make, self._left = make, BUDGET if budget is None else budget

    def __missing__(self, part: str) -> Any:
        value = self._make(part)
        if len(part) <= LONGEST and self._left > 0:
            self._left -= ENTRY + sys.getsizeof(part) + sys.getsizeof(value)
            self[part] = value
        return value


_held: dict[str, Any] = {}


def memo(name: str, maker: Callable[[], Callable[[str], Any]], budget: int | None = None) -> Memo:
    """This process's memo of that name. A process holds one: the first batch of another stage lets it go."""
    if _held.get("name") != name:
        _held.clear()
        _held.update(name=name, memo=Memo(maker(), budget))
    return _held["memo"]


def let_go() -> None:
    """Empty this process's memo: a step without one needs the memory, and workers outlive their tasks."""
    _held.clear()


def whole_texts(column: pa.Array) -> list[str]:
    """The texts of a batch, null as empty."""
    return ["" if t is None else t for t in column.to_pylist()]


@lru_cache(maxsize=2)
def tokenizer(path: str):
    """The tokenizers library's object for a file, once in each process."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)
