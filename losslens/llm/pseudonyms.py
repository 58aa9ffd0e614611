"""Format-preserving pseudonyms for personal data (DataFrame / SQL only).

A text is searched once for candidates; each is validated by the rules of its
kind, and what fails them stays as it is:

* card: 13 to 19 digits, plain or in groups, with a right Luhn digit;
* iban: country, check digits and account that give 1 modulo 97;
* ssn: no area 000, 666 or 9xx, no group 00, no serial 0000;
* ip: four numbers up to 255;
* date: a day of the years 1800 to 2199, as y-m-d, d/m/y, d.m.y or, where
  that is no day, m/d/y;
* phone: 8 to 15 digits after a plus sign, or ten as (999) 999-9999 or
  999-999-9999;
* email: its local part;
* secret: the value assigned to a token, key, secret or password.

Valid values are permuted by a keyed Feistel network inside their format:
``ROUNDS`` rounds add a SHA-256 of (key, kind, round, other half) to one half
and swap.  Numbers with a dense domain (ip, ssn, date) permute in two residues
that cover it exactly; others permute character by character, digits to digits
and letters to letters of the same case, with separators, country codes and
domains in place, and check digits are computed anew.  The map is one-to-one
on the values of a kind (dates read as m/d/y excepted, which may meet others)
and the same in every document, so equal values stay linked.

All of it is row-local SQL without a shuffle.  Defined cases: null text stays
null; texts without candidates come back unchanged; repeated rows and ties do
not matter; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

# fixed values: what candidates of each kind look like
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}",
    "secret": (r"(?i:(?<![a-z0-9])(?:token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key|secret[_-]?key))"
               r"[\"']?\s{0,4}[:=]\s{0,4}[\"']?[A-Za-z0-9_+/-]{8,512}+"),
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "date": (r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})"
             r"(?![0-9]|[./-][0-9])"),
    "card": (r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})"
             r"(?![0-9])"),
    "phone": (r"\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
              r"|\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{1,4}(?:[ .-]?[0-9]{2,4}(?![0-9]*\.[0-9])){1,4}(?![0-9])"
              r"|(?<![0-9])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])"),
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def _hash(key: str, *parts: str) -> str:
    """SQL: keyed pseudorandom number below 2^48."""
    return f"cast(conv(substr(sha2(concat_ws('|', '{key}', {', '.join(parts)}), 256), 1, 12), 16, 10) AS bigint)"


def _two_residues(a: str, b: str, size_a: int, size_b: int, key: str, kind: str) -> str:
    """SQL: struct(a, b) permuted over size_a * size_b pairs."""
    return (f"aggregate(sequence(1, {ROUNDS}), struct(cast({a} AS bigint) AS a, cast({b} AS bigint) AS b, "
            f"{size_a}L AS na, {size_b}L AS nb), (s, r) -> struct(s.b AS a, "
            f"(s.a + {_hash(key, repr(kind), 'r', 's.b')}) % s.na AS b, s.nb AS na, s.na AS nb))")


def _characters(v: str, start: str, stop: str, key: str, kind: str, hexadecimal: str = "false") -> str:
    """SQL: letters and digits of v at places start <= i < stop permuted."""
    chars = f"filter(split({v}, ''), c -> c <> '')"
    item = (f"struct(i AS i, CASE WHEN c RLIKE '[0-9]' THEN 10L WHEN {hexadecimal} THEN 6L ELSE 26L END AS n, "
            "CASE WHEN c RLIKE '[0-9]' THEN 48L WHEN c RLIKE '[a-z]' THEN 97L ELSE 65L END AS z, "
            "cast(ascii(c) AS bigint) AS x)")
    symbols = (f"transform(filter(transform({chars}, (c, i) -> struct({item} AS s, "
               f"i >= {start} AND i < {stop} AND c RLIKE '[A-Za-z0-9]' AS m)), e -> e.m), (e, j) -> "
               "struct(e.s.i AS i, j AS j, e.s.n AS n, e.s.z AS z, e.s.x - e.s.z AS x))")
    halves = (f"transform(array({symbols}), y -> struct(slice(y, 1, cast(size(y) / 2 AS int)) AS a, "
              "slice(y, cast(size(y) / 2 AS int) + 1, size(y)) AS b))[0]")
    other = "array_join(transform(s.b, y -> cast(y.x AS string)), ',')"
    # a symbol is known by its number, not its place: layouts of one value agree
    move = (f"transform(s.a, x -> struct(x.i AS i, x.j AS j, x.n AS n, x.z AS z, "
            f"(x.x + {_hash(key, repr(kind), 'r', 'cast(x.j AS string)', other)}) % x.n AS x))")
    done = f"aggregate(sequence(1, {ROUNDS}), {halves}, (s, r) -> struct(s.b AS a, {move} AS b))"
    new = (f"transform(array({done}), d -> map_from_entries(transform(concat(d.a, d.b), "
           "x -> struct(x.i AS i, chr(x.z + x.x) AS c))))[0]")
    return (f"transform(array({new}), m -> array_join(transform({chars}, (c, i) -> coalesce(m[i], c)), ''))[0]")


def _digits(v: str) -> str:
    return f"regexp_replace({v}, '[^0-9]', '')"


def _luhn(d: str, odd: int) -> str:
    """SQL: Luhn sum of digits d, doubling every second one from the right,
    beginning with the first (odd = 0) or second (odd = 1)."""
    x = f"cast(substr(reverse({d}), i, 1) AS int)"
    return (f"aggregate(sequence(1, length({d})), 0, (s, i) -> s + CASE WHEN (i + {odd}) % 2 = 0 THEN {x} "
            f"WHEN {x} > 4 THEN 2 * {x} - 9 ELSE 2 * {x} END)")


def _mod97(s: str) -> str:
    """SQL: a string of digits and capitals (A = 10) modulo 97."""
    return (f"aggregate(filter(split({s}, ''), c -> c <> ''), 0, (a, c) -> CASE WHEN c RLIKE '[0-9]' "
            "THEN (a * 10 + cast(c AS int)) % 97 ELSE (a * 100 + ascii(c) - 55) % 97 END)")


def _day(v: str) -> str:
    """SQL: struct(day, layout) of a date; layout 0 y-m-d, 1 d/m/y or d.m.y, 2 m/d/y."""
    year, first, second = f"substr({v}, 7, 4)", f"substr({v}, 1, 2)", f"substr({v}, 4, 2)"
    iso = f"try_to_date({v}, 'yyyy-MM-dd')"
    dmy = f"try_to_date(concat({year}, '-', {second}, '-', {first}), 'yyyy-MM-dd')"
    mdy = f"try_to_date(concat({year}, '-', {first}, '-', {second}), 'yyyy-MM-dd')"
    return (f"CASE WHEN substr({v}, 5, 1) = '-' THEN struct({iso} AS day, 0 AS layout) "
            f"WHEN {dmy} IS NOT NULL THEN struct({dmy} AS day, 1 AS layout) "
            f"WHEN substr({v}, 3, 1) = '/' THEN struct({mdy} AS day, 2 AS layout) "
            "ELSE struct(cast(null AS date) AS day, 0 AS layout) END")


FIRST_DAY = "date'1800-01-01'"
DAYS = 146097  # of 400 years; 189 * 773


def _date(v: str, key: str) -> str:
    place = f"datediff({_day(v)}.day, {FIRST_DAY})"
    new = _two_residues(f"{place} div 773", f"{place} % 773", 189, 773, key, "date")
    day = f"transform(array({new}), s -> date_add({FIRST_DAY}, cast(s.a * 773 + s.b AS int)))[0]"
    sep = f"substr({v}, 3, 1)"
    return (f"transform(array(struct({day} AS d, {_day(v)}.layout AS l)), x -> CASE x.l "
            "WHEN 0 THEN date_format(x.d, 'yyyy-MM-dd') "
            f"WHEN 1 THEN concat_ws({sep}, date_format(x.d, 'dd'), date_format(x.d, 'MM'), date_format(x.d, 'yyyy')) "
            f"ELSE concat_ws({sep}, date_format(x.d, 'MM'), date_format(x.d, 'dd'), date_format(x.d, 'yyyy')) END)[0]")


def _kind(v: str) -> str:
    """SQL: the kind of a valid candidate, else null."""
    compact = f"replace({v}, ' ', '')"
    octets = f"split({v}, r'\\.')"
    return f"""CASE
        WHEN {v} LIKE '%@%' THEN 'email'
        WHEN {v} RLIKE r'[:=]' THEN 'secret'
        WHEN {v} RLIKE r'^[A-Z]{{2}}[0-9]{{2}}' THEN
            if({_mod97(f"concat(substr({compact}, 5), substr({compact}, 1, 4))")} = 1, 'iban', null)
        WHEN {v} RLIKE r'^[0-9]{{1,3}}(\\.[0-9]{{1,3}}){{3}}$' THEN
            if(forall({octets}, o -> cast(o AS int) <= 255), 'ip', null)
        WHEN {v} RLIKE r'^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$' THEN
            if({v} RLIKE r'^(?!000|666|9)[0-9]{{3}}-(?!00)[0-9]{{2}}-(?!0000)', 'ssn', null)
        WHEN {v} RLIKE r'^([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{2}}([./])[0-9]{{2}}\\2[0-9]{{4}})$' THEN
            if(year({_day(v)}.day) BETWEEN 1800 AND 2199, 'date', null)
        WHEN {v} RLIKE r'^[0-9 -]+$' AND length({_digits(v)}) >= 13 THEN
            if({_luhn(_digits(v), 1)} % 10 = 0, 'card', null)
        WHEN {v} LIKE '+%' THEN if(length({_digits(v)}) BETWEEN 8 AND 15, 'phone', null)
        WHEN length({_digits(v)}) = 10 THEN 'phone' END"""


def _card(v: str, key: str) -> str:
    moved = _characters(v, "0", f"(length({v}) - 1)", key, "card")
    head = "substr(w, 1, length(w) - 1)"
    return (f"transform(array({moved}), w -> concat({head}, "
            f"cast((10 - {_luhn(_digits(head), 0)} % 10) % 10 AS string)))[0]")


def _iban(v: str, key: str) -> str:
    moved = _characters(v, "4", f"length({v})", key, "iban")
    rest = "concat(replace(substr(w, 5), ' ', ''), substr(w, 1, 2), '00')"
    return (f"transform(array({moved}), w -> concat(substr(w, 1, 2), "
            f"lpad(cast(98 - {_mod97(rest)} AS string), 2, '0'), substr(w, 5)))[0]")


def _ip(v: str, key: str) -> str:
    o = [f"cast(split({v}, r'\\.')[{k}] AS bigint)" for k in range(4)]
    new = _two_residues(f"{o[0]} * 256 + {o[1]}", f"{o[2]} * 256 + {o[3]}", 65536, 65536, key, "ip")
    return f"transform(array({new}), s -> concat_ws('.', s.a div 256, s.a % 256, s.b div 256, s.b % 256))[0]"


def _ssn(v: str, key: str) -> str:
    area = f"cast(substr({v}, 1, 3) AS int)"
    rest = f"(cast(substr({v}, 5, 2) AS int) - 1) * 9999 + cast(substr({v}, 8, 4) AS int) - 1"
    new = _two_residues(f"{area} - 1 - if({area} > 666, 1, 0)", rest, 898, 99 * 9999, key, "ssn")
    return (f"transform(array({new}), s -> concat_ws('-', lpad(cast(s.a + 1 + if(s.a >= 665, 1, 0) AS string), 3, '0'), "
            "lpad(cast(s.b div 9999 + 1 AS string), 2, '0'), lpad(cast(s.b % 9999 + 1 AS string), 4, '0')))[0]")


def _pseudonym(v: str, kind: str, key: str) -> str:
    value = f"regexp_extract({v}, r'[A-Za-z0-9_+/-]+$', 0)"
    return f"""CASE {kind}
        WHEN 'email' THEN {_characters(v, '0', f"(instr({v}, '@') - 1)", key, 'email')}
        WHEN 'secret' THEN {_characters(v, f'(length({v}) - length({value}))', f'length({v})', key, 'secret',
                                        f"({value} RLIKE '^([0-9a-f]+|[0-9A-F]+)$')")}
        WHEN 'iban' THEN {_iban(v, key)}
        WHEN 'ip' THEN {_ip(v, key)}
        WHEN 'ssn' THEN {_ssn(v, key)}
        WHEN 'date' THEN {_date(v, key)}
        WHEN 'card' THEN {_card(v, key)}
        WHEN 'phone' THEN {_characters(v, f"length(regexp_extract({v}, r'^[+][0-9]{{1,3}}(?=[ .(-])|^[+][0-9]', 0))",
                                       f'length({v})', key, 'phone')}
        ELSE {v} END"""


def pseudonymize(documents: DataFrame, key: str, text_col: str = "text", found_col: str | None = "private") -> DataFrame:
    """The documents with valid personal data replaced in the text column, and
    in ``found_col`` an array of (kind, pseudonym) in order of place; where the
    input has that column already, underscores are added to the name.  None:
    no such column.  Who has the key can undo the pseudonyms."""
    if not key:
        raise ValueError("a key is needed")
    while found_col in documents.columns:
        found_col += "_"
    key = key.replace("\\", "\\\\").replace("'", "\\'")
    text = F.col("row")[text_col]
    found = (documents.select(F.struct("*").alias("row"))
             .withColumn("found", F.when(text.rlike("[0-9@=:]"), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
                         .otherwise(F.array().cast("array<string>")))
             .withColumn("found", F.expr(f"transform(found, v -> struct({_kind('v')} AS kind, v AS v))"))
             .withColumn("found", F.expr(
                 f"transform(found, f -> struct(f.kind AS kind, {_pseudonym('f.v', 'f.kind', key)} AS v))")))
    pieces = F.split(text, ANY, -1)
    joined = F.array_join(F.concat(
        F.slice(F.col("pieces"), 1, 1),
        F.zip_with(F.col("found"), F.expr("slice(pieces, 2, size(pieces))"), lambda f, p: F.concat(f["v"], p))), "")
    out = (found.withColumn("pieces", F.when(F.size("found") > 0, pieces))
           .withColumn("new", F.when(F.size("found") > 0, joined).otherwise(text)))
    private = F.expr("transform(filter(found, f -> f.kind IS NOT NULL), f -> struct(f.kind AS kind, f.v AS pseudonym))")
    columns = [F.col("new").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in documents.columns]
    return out.select(*columns, *([private.alias(found_col)] if found_col else []))
