"""Characters on which the tokenizer libraries and Python disagree, as they
follow other versions of Unicode."""

from __future__ import annotations

import re

# Letters and numbers that Unicode 16 does not have (inclusive ranges).
LATER_LETTERS = (
    (0x0558, 0x0558), (0x058B, 0x058C), (0x088F, 0x088F), (0x0C5C, 0x0C5C), (0x0CDC, 0x0CDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2),
    (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE),
    (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DF1, 0x11DF1), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF3), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2),
    (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6),
    (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE),
    (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F))
LATER_NUMBERS = (
    (0x11DE0, 0x11DE9), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16FF4, 0x16FF6))

# Combining marks that the library's normalisation takes for characters that combine with
# nothing, and the two parts of a letter that it does not put together.
MARKS_APART = (
    (0x07FD, 0x07FD), (0x0898, 0x089F), (0x08CA, 0x08D3), (0x09FE, 0x09FE), (0x0C3C, 0x0C3C), (0x0D3B, 0x0D3C),
    (0x0EBA, 0x0EBA), (0x1715, 0x1715), (0x1ABF, 0x1ACE), (0x1DF6, 0x1DFA), (0xA82C, 0xA82C), (0x10D24, 0x10D27),
    (0x10EAB, 0x10EAC), (0x10EFD, 0x10EFF), (0x10F46, 0x10F50), (0x10F82, 0x10F85), (0x11070, 0x11070),
    (0x1133B, 0x1133B), (0x1145E, 0x1145E), (0x11839, 0x1183A), (0x11930, 0x11930), (0x11935, 0x11935),
    (0x1193D, 0x1193E), (0x11943, 0x11943), (0x119E0, 0x119E0), (0x11A34, 0x11A34), (0x11A47, 0x11A47),
    (0x11A99, 0x11A99), (0x11D42, 0x11D42), (0x11D44, 0x11D45), (0x11D97, 0x11D97), (0x11F41, 0x11F42),
    (0x16FF0, 0x16FF1), (0x1E08F, 0x1E08F), (0x1E130, 0x1E136), (0x1E2AE, 0x1E2AE), (0x1E2EC, 0x1E2EF),
    (0x1E4EC, 0x1E4EF))

# Capitals that Python does not know yet (first, last) and the first one's lower-case letter.
LATER_CAPITALS = (
    (0x1C89, 0x1C89, 0x1C8A), (0xA7CB, 0xA7CB, 0x0264), (0xA7CC, 0xA7CC, 0xA7CD), (0xA7CE, 0xA7CE, 0xA7CF),
    (0xA7D2, 0xA7D2, 0xA7D3), (0xA7D4, 0xA7D4, 0xA7D5), (0xA7DA, 0xA7DA, 0xA7DB), (0xA7DC, 0xA7DC, 0x019B),
    (0x10D50, 0x10D65, 0x10D70), (0x16EA0, 0x16EB8, 0x16EBB))

#: Unicode's White_Space, as the body of a character class.
SPACE = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def class_body(ranges: tuple[tuple[int, int], ...]) -> str:
    """Inclusive ranges of code points as the body of a character class."""
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


#: Whether a text has a letter or number that Unicode 16 does not have.
has_later = re.compile(f"[{class_body(LATER_LETTERS + LATER_NUMBERS)}]").search
