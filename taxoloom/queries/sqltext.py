"""SQL fragments that say the same as the text functions, for the side-by-side check."""

from __future__ import annotations

from taxoloom.functions import text


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def norm(c: str) -> str:
    src, dst = text.fold_table()
    x = f"translate(coalesce({c}, ''), {q(text.QUOTES + text.DASHES)}, {q(chr(39) * len(text.QUOTES) + ' ' * len(text.DASHES))})"
    for mark, letters in text.LIGATURES:
        x = f"replace({x}, {q(mark)}, {q(letters)})"
    x = f"regexp_replace(translate({x}, {q(src)}, {q(dst)}), '[^\\x00-\\x7F]', '', 'g')"
    return f"trim(regexp_replace(lower({x}), '\\s+', ' ', 'g'))"


def match_key(c: str) -> str:
    inner = norm(f"regexp_replace(coalesce({c}, ''), '\\([^)]*\\)', ' ', 'g')")
    return f"array_to_string(list_transform(string_split({inner}, ' '), lambda w: regexp_replace(w, '^(.{{2,}}[^s])s$', '\\1')), ' ')"


def verify_key(c: str) -> str:
    inner = norm(f"regexp_replace(coalesce({c}, ''), '\\s*\\([^)]*\\)\\s*$', '')")
    return f"array_to_string(list_transform(string_split({inner}, ' '), lambda w: regexp_replace(w, 's$', '')), ' ')"


def mint(prefix: str, source: str, key: str) -> str:
    return f"'{prefix}' || substr(sha1(coalesce({source}, '') || '|' || coalesce({key}, '')), 1, 12)"


def rule_case(x: str, rules: tuple[tuple[str, str], ...], other: str) -> str:
    return "case " + " ".join(f"when regexp_matches({x}, {q(p)}) then {q(n)}" for n, p in rules) + f" else {other} end"


def blank_null(c: str) -> str:
    return f"nullif(trim(coalesce({c}, '')), '')"
