"""Format-preserving Feistel pseudonyms for personal data in texts.

Every validated value is replaced by another value of the same format, found
with a keyed permutation of that format's values.  The permutation depends on
the value and the key alone, so equal values stay linked across documents and
different values stay different.  SQL functions only: one regular expression
cuts a text into gaps and values, a lambda maps the values, and the pieces are
joined again.

Kinds: payment card numbers of 13 to 19 digits with a right check digit (the
digits before it are permuted, the check digit is computed anew), North
American telephone numbers (any area; those that begin with 0 among themselves), IPv4 addresses, social security numbers, calendar
dates of 1900 to 2099, local parts of mail addresses and the values of keys,
tokens and passwords (six characters or more, of any length; in quotes up to the
closing quote, else up to white space).  A number or date that fails its validation stays.

Numbers: a generalised Feistel network over Z_a x Z_b with a * b the exact
number of values, so no value leaves the format.  Strings: the two halves are
shifted in turn, each character within its class (digits, lower case, upper
case; hexadecimal strings within their sixteen digits); marks and letters beyond
ASCII stay.

Defined cases: a null text stays null, an empty one empty; texts of any length
are handled in one pass; rows are independent, so repeated rows give repeated
results and an empty table an empty one; all further columns are kept and no
working column is added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
#: A longer half of a string enters the round's hash as a digest, so that long strings take linear time.
LONG_HALF = 64

# What a date's two factors (Z_319 x Z_229 = 73 049 days from 1900-01-01 to 2099-12-31) come from.
DATE_A, DATE_B, FIRST_DAY = 319, 229, "1900-01-01"

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_SECRET_NAME = r"(?:password|passwd|pwd|token|secret|api_?key)"
_SECRET_HEAD = rf"(?i:{_SECRET_NAME})[\x22\x27]?\s{{0,4}}[=:]\s{{0,4}}"
# at least six characters: in quotes up to the closing one on the line, else up to white space or a quote, without marks at the end
_SECRET_VALUE = ("(?:" + "|".join(rf"{q}(?!.{{0,5}}(?<!\\){q})(?=.{{6,}}?(?<!\\){q}).*?(?=(?<!\\){q})" for q in (r"\x22", r"\x27"))
                 + r"|[\x22\x27]?(?=[^\s\x22\x27]{6})[^\s\x22\x27]*[\p{L}\p{N}+/_.-])")
PATTERNS = {
    # a host has at most 126 labels before the last; an unbounded group would take a stack frame per label
    "mail": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}\.){1,126}[A-Za-z]{2,24}",
    "phone": r"(?<![\w+])\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?[2-9]\d\d[ .-]?\d{4}(?!\d)",
    "ip": rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?![\w]|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "date": r"(?<![\w/-])(?:(?:19|20)\d\d(?:-\d\d-\d\d|/\d\d/\d\d)|\d\d\.\d\d\.(?:19|20)\d\d|\d\d/\d\d/(?:19|20)\d\d)(?![\w/-])",
    "card": r"(?<![\w-])(?:\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{13,19})(?![\w])",
    "key": r"(?<!\w)AKIA[0-9A-Z]{16}(?!\w)",
    "secret": rf"(?<![A-Za-z]){_SECRET_HEAD}{_SECRET_VALUE}",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Only a text with one of these can hold a value.
MAY_HOLD = rf"[0-9@]|(?i:{_SECRET_NAME})"


def _hash(key: str, tweak: str, i: str, value: str) -> str:
    """60 pseudo-random bits of the key, the kind, the round and the other half."""
    parts = f"concat_ws('|', {key}, '{tweak}', cast({i} as string), cast({value} as string))"
    return f"cast(conv(substr(sha2({parts}, 256), 1, 15), 16, 10) as bigint)"


def permute_number(high: str, low: str, a: str, b: str, key: str, tweak: str) -> str:
    """SQL of the permuted pair (l, r) of Z_a x Z_b."""
    return f"""aggregate(sequence(0, {ROUNDS - 1}),
      named_struct('l', cast({high} as bigint), 'r', cast({low} as bigint)),
      (s, i) -> if(i % 2 = 0,
        named_struct('l', (s.l + {_hash(key, tweak, 'i', 's.r')} % ({a})) % ({a}), 'r', s.r),
        named_struct('l', s.l, 'r', (s.r + {_hash(key, tweak, 'i', 's.l')} % ({b})) % ({b}))))"""


def permute_string(value: str, key: str, tweak: str) -> str:
    """SQL of a string whose characters are shifted within their classes."""
    classes = """case when hex then '0123456789abcdef'
      when c between '0' and '9' then '0123456789' when c between 'a' and 'z' then 'abcdefghijklmnopqrstuvwxyz'
      when c between 'A' and 'Z' then 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' else c end"""

    def mixed(half: str, other: str) -> str:
        shift = _hash(key, tweak, rounds, "w")
        return _with("w", f"if(length({other}) > {LONG_HALF}, sha2({other}, 256), {other})",
                     f"array_join(transform(regexp_extract_all({half}, '(?s).', 0), (c, p) -> "
                     f"substr({classes}, cast((instr({classes}, c) - 1 + {shift}) % length({classes}) + 1 as int), 1)), '')")

    rounds = f"if(length({value}) > {2 * LONG_HALF}, concat(i, '.', p), cast(i * 1000 + p as string))"  # p may pass 1000
    whole = f"""aggregate(sequence(0, {ROUNDS - 1}),
      named_struct('l', substr({value}, 1, cast(length({value}) div 2 as int)), 'r', substr({value}, cast(length({value}) div 2 as int) + 1)),
      (s, i) -> if(i % 2 = 0, named_struct('l', {mixed('s.l', 's.r')}, 'r', s.r), named_struct('l', s.l, 'r', {mixed('s.r', 's.l')})),
      s -> concat(s.l, s.r))"""
    return _with("hex", f"{value} rlike '^[0-9a-f]+$' and {value} rlike '[a-f]'", whole)


def _with(name: str, value: str, then: str) -> str:
    """SQL of ``then``, in which ``name`` stands for ``value`` computed once."""
    return f"element_at(transform(array({value}), {name} -> {then}), 1)"


def refilled(shape: str, digits: str) -> str:
    """SQL of ``shape`` with its digits replaced by ``digits``, in order."""
    return f"""aggregate(regexp_extract_all({shape}, '(?s).', 0), named_struct('out', '', 'at', 1),
      (f, ch) -> if(ch between '0' and '9', named_struct('out', concat(f.out, substr({digits}, f.at, 1)), 'at', f.at + 1),
                    named_struct('out', concat(f.out, ch), 'at', f.at)),
      f -> f.out)"""


def _card(m: str, key: str) -> str:
    low = "cast(power(10, n - n div 2) as bigint)"
    pair = permute_number("substr(d, 1, n div 2)", "substr(d, n div 2 + 1, n - n div 2)", "cast(power(10, n div 2) as bigint)", low, key, "card")
    body = f"concat(lpad(cast(x.l as string), n div 2, '0'), lpad(cast(x.r as string), n - n div 2, '0'))"
    whole = _with("e", body, "concat(e, cast(filter(sequence(0, 9), z -> luhn_check(concat(e, cast(z as string))))[0] as string))")
    new = _with("d", "regexp_replace(m, '[^0-9]', '')", _with("n", "cast(length(d) - 1 as int)", f"if(luhn_check(d), {_with('x', pair, whole)}, d)"))
    return _with("y", new, refilled(m, "y"))


def _phone(m: str, key: str) -> str:
    # area 100-999: 900 values, 000-099: 100 values, each among themselves; exchange 200-999: 800; line: 10 000;
    # as (area, first half of line) x (exchange, second half)
    first, areas = "if(substr(d, 2, 1) = '0', 0, 100)", "if(substr(d, 2, 1) = '0', 10000, 90000)"
    pair = permute_number(f"(cast(substr(d, 2, 3) as bigint) - {first}) * 100 + cast(substr(d, 8, 2) as bigint)",
                          "(cast(substr(d, 5, 3) as bigint) - 200) * 100 + cast(substr(d, 10, 2) as bigint)", areas, "80000", key, "phone")
    digits = (f"concat('1', lpad(cast(x.l div 100 + {first} as string), 3, '0'), cast(x.r div 100 + 200 as string), "
              "lpad(cast(x.l % 100 as string), 2, '0'), lpad(cast(x.r % 100 as string), 2, '0'))")
    return _with("y", _with("d", f"regexp_replace({m}, '[^0-9]', '')", _with("x", pair, digits)), refilled(m, "y"))


def _ip(m: str, key: str) -> str:
    pair = permute_number("cast(o[0] as bigint) * 256 + cast(o[1] as bigint)", "cast(o[2] as bigint) * 256 + cast(o[3] as bigint)", "65536", "65536", key, "ip")
    text = "concat_ws('.', cast(x.l div 256 as string), cast(x.l % 256 as string), cast(x.r div 256 as string), cast(x.r % 256 as string))"
    return _with("o", f"split({m}, '[.]')", _with("x", pair, text))


def _ssn(m: str, key: str) -> str:
    # areas 001-899 without 666: 898; groups 01-99; serials 0001-9999
    area = "cast(substr(m, 1, 3) as bigint)"
    pair = permute_number(f"({area} - 1 - if({area} > 666, 1, 0)) * 99 + cast(substr(m, 5, 2) as bigint) - 1", "cast(substr(m, 8, 4) as bigint) - 1", "898 * 99", "9999", key, "ssn")
    text = ("concat(lpad(cast(x.l div 99 + 1 + if(x.l div 99 + 1 >= 666, 1, 0) as string), 3, '0'), '-', "
            "lpad(cast(x.l % 99 + 1 as string), 2, '0'), '-', lpad(cast(x.r + 1 as string), 4, '0'))")
    valid = "substr(m, 1, 3) not in ('000', '666') and substr(m, 1, 1) <> '9' and substr(m, 5, 2) <> '00' and substr(m, 8, 4) <> '0000'"
    return f"if({valid}, {_with('x', pair, text)}, {m})"


def _date(m: str, key: str) -> str:
    # year first: y-m-d or y/m/d; d.m.y; m/d/y
    shape = f"case when substr({m}, 5, 1) = '-' then 'yyyy-MM-dd' when substr({m}, 5, 1) = '/' then 'yyyy/MM/dd' when substr({m}, 3, 1) = '.' then 'dd.MM.yyyy' else 'MM/dd/yyyy' end"
    day = f"case when substr({m}, 5, 1) in ('-', '/') then concat_ws('-', substr({m}, 1, 4), substr({m}, 6, 2), substr({m}, 9, 2)) when substr({m}, 3, 1) = '.' then concat_ws('-', substr({m}, 7, 4), substr({m}, 4, 2), substr({m}, 1, 2)) else concat_ws('-', substr({m}, 7, 4), substr({m}, 1, 2), substr({m}, 4, 2)) end"
    pair = permute_number(f"t div {DATE_B}", f"t % {DATE_B}", str(DATE_A), str(DATE_B), key, "date")
    new = _with("x", pair, f"date_format(date_add(date'{FIRST_DAY}', cast(x.l * {DATE_B} + x.r as int)), {shape})")
    return _with("t", f"datediff(try_cast({day} as date), date'{FIRST_DAY}')", f"if(t is null, {m}, {new})")


def _mail(m: str, key: str) -> str:
    return f"concat({_with('v', f"substring_index({m}, '@', 1)", permute_string('v', key, 'mail'))}, '@', substring_index({m}, '@', -1))"


def _key(m: str, key: str) -> str:
    return f"concat('AKIA', {_with('v', f'substr({m}, 5)', permute_string('v', key, 'key'))})"


def _secret(m: str, key: str) -> str:
    value = rf"regexp_replace({m}, r'^{_SECRET_HEAD}[\x22\x27]?', '')"
    return _with("v", value, f"concat(substr({m}, 1, length({m}) - length(v)), {permute_string('v', key, 'secret')})")


def pseudonym(m: str, key: str) -> str:
    """SQL of the pseudonym of one value that :data:`PATTERN` has found."""
    return rf"""case
      when {m} rlike r'^AKIA[0-9A-Z]{{16}}\z' then {_key(m, key)}
      when {m} rlike r'^{_SECRET_HEAD}' then {_secret(m, key)}
      when instr({m}, '@') > 0 then {_mail(m, key)}
      when startswith({m}, '+') then {_phone(m, key)}
      when {m} rlike r'^\d{{1,3}}(?:[.]\d{{1,3}}){{3}}\z' then {_ip(m, key)}
      when {m} rlike r'^\d{{3}}-\d{{2}}-\d{{4}}\z' then {_ssn(m, key)}
      when length({m}) = 10 then {_date(m, key)}
      else {_card(m, key)} end"""


def pseudonymised(text: str, key: str) -> Column:
    """The column ``text`` with every value replaced by its pseudonym under ``key``."""
    literal = "'" + key.replace("\\", "\\\\").replace("'", "\\'") + "'"
    name = "`" + text.replace("`", "``") + "`"
    gaps = f'split({name}, r"{PATTERN}", -1)'
    values = f'regexp_extract_all({name}, r"{PATTERN}", 0)'
    new = f"transform({values}, m -> {pseudonym('m', literal)})"
    joined = f"array_join(zip_with({gaps}, concat({new}, array('')), (gap, value) -> concat(gap, value)), '')"
    return F.expr(f'case when {name} rlike r"{MAY_HOLD}" then {joined} else {name} end')


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with the column ``text`` pseudonymised; all columns stay."""
    return docs.withColumn(text, pseudonymised(text, key))
