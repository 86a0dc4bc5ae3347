"""Texts as segments that byte-level BPE encodes one by one."""

from __future__ import annotations

import re

# The White_Space characters of Unicode other than the space.
WHITE = "".join(map(chr, (9, 10, 11, 12, 13, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
                          0x205F, 0x3000)))
#: A segment ends before a run of spaces that follows a character that is no
#: white space.  The tokenizers' pattern never matches over such a place, as a
#: space is in it only at a word's start or among white space.
SEGMENT = re.compile(f" *[^ ]+(?:(?<=[{WHITE}]) +[^ ]*)*| +")
