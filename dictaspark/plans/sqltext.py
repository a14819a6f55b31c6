"""SQL fragments for the text functions, in DuckDB's dialect."""

from __future__ import annotations

from dictaspark import lexicons as L

SPACE = r" \t\n\x0B\f\r\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def word_count(x: str) -> str:
    return f"len(regexp_extract_all(coalesce({x}, ''), '[^{SPACE}]+'))"


def collapse(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '[{SPACE}]+', ' ', 'g'), '^ | $', '', 'g')"


def dedup_key(x: str) -> str:
    return f"lower({collapse(x)})"


def tokens(x: str) -> str:
    """Deaccented lower-case words with apostrophes."""
    return f"regexp_extract_all(strip_accents(lower(translate({x}, '’ʼ', ''''''))), '[a-z'']+')"


def quoted(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def content(x: str, lang: str) -> str:
    return (f"list_filter(list_transform({tokens(x)}, lambda w: regexp_replace(w, '^''+|''+$', '', 'g')), "
            f"lambda w: len(w) > 1 AND w NOT IN ({quoted(L.TOOLS[lang])}))")


def stem(w: str, lang: str) -> str:
    cases = " ".join(f"WHEN suffix({w}, '{s}') AND len({w}) - {len(s)} >= 3 THEN left({w}, len({w}) - {len(s)})" for s in L.SUFFIXES[lang])
    return f"CASE {cases} ELSE {w} END"


def axis(name: str, default: str) -> str:
    return f"coalesce(nullif(lower({collapse(f'''regexp_extract(coalesce(control, ''), '(?i)\\[\\s*{name}\\s*:\\s*([^\\]]*?)\\s*\\]', 1)''')}), ''), '{default}')"
