"""Format-preserving pseudonyms of personal data by keyed Feistel networks (operator 3).

Every validated value is an element of a finite set with its format: the payload digits of a card number, the ten
digits of a telephone number, the 2**32 addresses, the days of 400 years. The set is written as two mixed-radix
halves, and rounds add to one half a keyed hash of the other, modulo its radix. That permutes the set exactly, with no
retries: a value's pseudonym is valid, differs by key, is the same in every document, and no two values share one.

    card      13 to 19 digits, Luhn-valid, in groups by blank, hyphen or dot; first digit stays, the check digit is computed anew. In a longer
              run of digit groups, whole groups are tried from the left, the most digits first: where a group beside
              a card makes a valid number with it by chance, both are replaced as one
    phone     ten digits 3-3-4 by blank, dot or hyphen, after +1 or 1 or not; area code and number stay in the
              ranges that can be dialled (from 2) if they were there. A bare run of ten digits counts where it could be dialled: area code and
              exchange from 2, no second digit 9 of the area code, neither ending in 11; so times and serial numbers stay
    intl      + or 00 and 8 to 15 digits of another country; the first three, which hold the country's code, stay
    national  an area code from 0 and 10 or 11 digits in all, in groups; the first three stay
    iban      valid by its check digits, which are computed anew; letters stay, in capitals or not
    ssn       898 x 99 x 9999 valid numbers as 88902 x 9999, by hyphens or blanks
    ipv4      65536 x 65536, octets without leading zeros
    date      year-month-day, year/month/day, day/month/year, day.month.year or, where only that can be meant, month/day/year, of 1800 to
              2199: 146097 days as 189 x 773; leading zeros as they were written
    email     letters and digits of the local part, each within its class; the domain, of at most 127 labels, stays

Digits are permuted without their separators, so a value written in two ways keeps one pseudonym. Everything is
SQL expressions inside one projection: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import columns, packed, table, unpacked

#: Session setting with the secret key of the registered query and the pipeline; without it they use a public one.
KEY_SETTING, PUBLIC_KEY = "spark.folioscope.pseudonymKey", "public"
ROUNDS = 10

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_DAY, _MONTH, _YEAR = "(?:0?[1-9]|[12][0-9]|3[01])", "(?:0?[1-9]|1[0-2])", "(?:1[89]|2[01])[0-9]{2}"
_DIALLED = "(?![0-9]11)[2-9][0-8][0-9](?![0-9]11)[2-9][0-9]{2}[0-9]{4}"
#: Forms, in order of precedence; a kind is told from a match by the tests of ``_pseudonym``. No group repeats without a bound: each repeat would be
#: a call on the stack, which a long text could overflow.
FORMS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){0,126}\.[A-Za-z]{2,}",
    "ipv4": rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?[0-9])",
    "date": rf"(?<![0-9-]){_YEAR}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])(?![0-9-])|(?<![0-9/]){_YEAR}/{_MONTH}/{_DAY}(?![0-9/])|(?<![0-9./])(?:{_DAY}\.{_MONTH}\.|{_DAY}/{_MONTH}/|{_MONTH}/{_DAY}/){_YEAR}(?![0-9/])",
    "phone": r"(?:(?<![0-9])\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}|(?:(?<![0-9.-])1[ .-])?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}|(?<![0-9.-])(?:1[ .-])?[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4})(?!-?[0-9])"
    rf"|(?<![A-Za-z0-9_.-]){_DIALLED}(?![A-Za-z0-9_]|[.-][0-9])",
    "ssn": "|".join(rf"(?<![0-9-])(?!000|666|9)[0-9]{{3}}{by}(?!00)[0-9]{{2}}{by}(?!0000)[0-9]{{4}}(?![0-9-])" for by in "- "),
}
FORMS["intl"] = r"(?<![0-9+])\+(?!1(?:[ .-]|[0-9]{10}(?![0-9])))[1-9][0-9]{0,2}(?:[ .-]?\(?[0-9]{1,4}\)?){2,6}(?![0-9])|(?<![0-9+.-])00[1-9][0-9]{0,2}[ .-]\(?[0-9]{1,4}\)?(?:[ .-]?\(?[0-9]{1,4}\)?){1,5}(?![0-9])"
FORMS["national"] = r"(?:(?<![0-9])\(0[0-9]{2,4}\) ?|(?<![0-9.+-])0[0-9]{2,4}[ -])[0-9]{3,4}[ -]?[0-9]{3,4}(?![0-9])"
FORMS["iban"] = (
    r"(?<![A-Za-z0-9])(?:[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?|[a-z]{2}[0-9]{2}[a-z0-9]{11,30}|[a-z]{2}[0-9]{2}(?: [a-z]{4})?(?: [0-9]{4}){2,7}(?: [0-9]{1,3})?)(?![A-Za-z0-9])"
)
#: Digit groups up to the next value of another kind.
FORMS["card"] = rf"(?<![0-9])(?=(?:[0-9][ .-]?){{13}})[0-9]++(?:[ .-](?!{'|'.join(f'(?:{FORMS[k]})' for k in ('ipv4', 'date', 'phone', 'ssn'))})[0-9]++)*+"
_ALL = "|".join(f"(?:{f})" for f in FORMS.values())


def _hash(key: str, kind: str, i: str, x: str) -> str:
    return f"cast(conv(substr(sha2(concat_ws('|', {key}, {kind}, {i}, {x}), 256), 1, 15), 16, 10) as bigint)"


def _feistel(left: str, right: str, a: str, b: str, kind: str, key: str) -> str:
    """Struct (l, r) of the permuted halves of the set a x b."""
    return (
        f"aggregate(sequence(1, {ROUNDS}), named_struct('l', cast({left} as bigint), 'r', cast({right} as bigint)), (s, i) -> if(i % 2 = 1, "
        f"named_struct('l', pmod(s.l + {_hash(key, kind, 'i', 's.r')}, cast({a} as bigint)), 'r', s.r), "
        f"named_struct('l', s.l, 'r', pmod(s.r + {_hash(key, kind, 'i', 's.l')}, cast({b} as bigint)))))"
    )


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _digits(digits: str, kind: str, key: str) -> str:
    """A string of digits permuted among those of its length."""
    half = f"(length({digits}) div 2)"
    ten = lambda n: f"concat('1', repeat('0', {n}))"
    f = _feistel(f"substr({digits}, 1, {half})", f"substr({digits}, {half} + 1)", ten(half), ten(f"length({digits}) - {half}"), f"concat({kind}, length({digits}))", key)
    return _let(f, "q", f"concat(lpad(cast(q.l as string), {half}, '0'), lpad(cast(q.r as string), length({digits}) - {half}, '0'))")


def _into(form: str, digits: str) -> str:
    """``form`` with its last digits, as many as given, replaced in order."""
    skip = f"length(regexp_replace({form}, '[^0-9]', '')) - length({digits})"
    return (
        f"aggregate(sequence(1, length({form})), named_struct('o', '', 'k', 0), (s, i) -> if(substr({form}, i, 1) rlike '[0-9]', "
        f"named_struct('o', concat(s.o, if(s.k < {skip}, substr({form}, i, 1), substr({digits}, s.k - ({skip}) + 1, 1))), 'k', s.k + 1), "
        f"named_struct('o', concat(s.o, substr({form}, i, 1)), 'k', s.k)), s -> s.o)"
    )


def _luhn(payload: str) -> str:
    """The check digit of a string of digits."""
    total = f"aggregate(sequence(1, length({payload})), cast(0 as bigint), (t, i) -> t + if((length({payload}) - i) % 2 = 0, (2 * cast(substr({payload}, i, 1) as int)) div 10 + (2 * cast(substr({payload}, i, 1) as int)) % 10, cast(substr({payload}, i, 1) as int)))"
    return f"cast((10 - {total} % 10) % 10 as string)"


def _email(m: str, key: str) -> str:
    local = f"split(substring_index({m}, '@', 1), '')"
    other = "array_join(filter(s, (c, j) -> (j + i) % 2 = 1), '')"
    shift = lambda c, base, n: f"char({base} + (ascii({c}) - {base} + p) % {n})"
    moved = f"case when c rlike '[0-9]' then {shift('c', 48, 10)} when c rlike '[a-z]' then {shift('c', 97, 26)} when c rlike '[A-Z]' then {shift('c', 65, 26)} else c end"
    pad = f"sha2(concat_ws('|', {key}, 'email', i, size(s), {other}), 512)"
    round_ = _let(pad, "h", f"transform(s, (c, j) -> if((j + i) % 2 = 0, {_let('cast(conv(substr(h, 1 + 2 * (j % 64), 2), 16, 10) as int)', 'p', moved)}, c))")
    return f"concat(array_join(aggregate(sequence(1, 6), {local}, (s, i) -> {round_}), ''), '@', substr({m}, instr({m}, '@') + 1))"


def _date(m: str, key: str) -> str:
    """The three numbers stay in their places, of one digit where they were so written."""
    first, second = "cast(p[0] as int)", "cast(p[1] as int)"
    order = f"case when length(p[0]) = 4 then 'ymd' when contains({m}, '/') and {second} > 12 then 'mdy' else 'dmy' end"
    iso = "case o when 'ymd' then concat_ws('-', p[0], lpad(p[1], 2, '0'), lpad(p[2], 2, '0')) when 'mdy' then concat_ws('-', p[2], lpad(p[0], 2, '0'), lpad(p[1], 2, '0')) else concat_ws('-', p[2], lpad(p[1], 2, '0'), lpad(p[0], 2, '0')) end"
    short = f"if(exists(p, x -> length(x) = 1), cast(cast(x as int) as string), x)".replace("exists(p, x -> length(x)", "exists(p, y -> length(y)")
    moved = _let(_feistel("n div 773", "n % 773", "189", "773", "'date'", key), "q", "split(date_format(date_add(date'1800-01-01', cast(q.l * 773 + q.r as int)), 'yyyy-MM-dd'), '-')")
    shown = _let(f"transform({moved}, x -> {short})", "d", f"concat_ws(regexp_extract({m}, '[-./]', 0), if(o = 'ymd', d[0], if(o = 'mdy', d[1], d[2])), if(o = 'mdy', d[2], d[1]), if(o = 'ymd', d[2], d[0]))")
    day = f"datediff(try_cast({iso} as date), date'1800-01-01')"
    return _let(f"split({m}, '[-./]')", "p", _let(order, "o", _let(day, "n", f"if(n is null, {m}, {shown})")))


def _ipv4(m: str, key: str) -> str:
    o = f"transform(split({m}, '[.]'), o -> cast(o as bigint))"
    q = _feistel("o[0] * 256 + o[1]", "o[2] * 256 + o[3]", "65536", "65536", "'ipv4'", key)
    return _let(o, "o", _let(q, "q", "concat_ws('.', q.l div 256, q.l % 256, q.r div 256, q.r % 256)"))


def _ssn(m: str, key: str) -> str:
    d = f"regexp_replace({m}, '[ -]', '')"
    area = "cast(substr(d, 1, 3) as int) - if(d >= '667', 2, 1)"
    q = _feistel(f"({area}) * 99 + cast(substr(d, 4, 2) as int) - 1", "cast(substr(d, 6, 4) as int) - 1", "88902", "9999", "'ssn'", key)
    back = f"concat_ws(substr({m}, 4, 1), lpad(cast(q.l div 99 + if(q.l div 99 >= 665, 2, 1) as string), 3, '0'), lpad(cast(q.l % 99 + 1 as string), 2, '0'), lpad(cast(q.r + 1 as string), 4, '0'))"
    return _let(d, "d", _let(q, "q", back))


def _card(m: str, key: str) -> str:
    """``m`` with its cards replaced: from the left, the longest valid sequence of whole digit groups."""
    bare = lambda x: f"regexp_replace({x}, '[^0-9]', '')"
    card = _let(bare("c"), "d", _let(_digits("substr(d, 2, length(d) - 2)", "'card'", key), "y", _let("concat(substr(d, 1, 1), y)", "w", _into("c", f"concat(w, {_luhn('w')})"))))
    valid = _let("array_join(slice(b, i, j - i + 1), '')", "d", f"if(length(d) between 13 and 19, {_luhn('substr(d, 1, length(d) - 1)')} = right(d, 1), false)")
    last = f"array_max(filter(sequence(i, least(size(g), i + 18)), j -> {valid}))"
    step = _let(last, "e", "if(e is null, s, named_struct('e', e, 'k', concat(s.k, array(named_struct('p', s.e, 'i', i, 'e', e)))))")
    none = "named_struct('e', 0, 'k', cast(array() as array<struct<p: int, i: int, e: int>>))"
    # what stands between cards is cut from the groups once, so that a run of very many groups is read in proportion
    each = f"concat(array_join(slice(g, z.p + 1, z.i - z.p - 1), ''), {_let('array_join(slice(g, z.i, z.e - z.i + 1), ' + chr(39) * 2 + ')', 'c', card)})"
    whole = f"concat(array_join(transform(s.k, z -> {each}), ''), array_join(slice(g, s.e + 1, size(g) - s.e), ''))"
    found = f"aggregate(sequence(1, size(g)), {none}, (s, i) -> if(i <= s.e, s, {step}))"
    return _let(f"regexp_extract_all({m}, '([0-9]+[ .-]?)', 1)", "g", _let(f"transform(g, x -> {bare('x')})", "b", _let(found, "s", f"if(size(s.k) = 0, {m}, {whole})")))


def _phone(m: str, key: str) -> str:
    d = f"right(regexp_replace({m}, '[^0-9]', ''), 10)"
    area, rest = "if(d >= '2', 200, 0)", "if(substr(d, 4, 1) >= '2', 2000000, 0)"
    wide = lambda low, n: f"if({low} > 0, {8 * n}, {2 * n})"
    kind = f"concat_ws('/', 'phone', {area}, {rest})"
    q = _feistel(f"cast(substr(d, 1, 3) as int) - {area}", f"cast(substr(d, 4) as int) - {rest}", wide(area, 100), wide(rest, 1000000), kind, key)
    back = f"concat(lpad(cast(q.l + {area} as string), 3, '0'), lpad(cast(q.r + {rest} as string), 7, '0'))"
    return _let(d, "d", _let(q, "q", _let(back, "b", _into(m, "b"))))


def _intl(m: str, key: str) -> str:
    """Of a number that begins with 00 the digits behind it count, so that it keeps the pseudonym of the one with +."""
    d = f"regexp_replace({m}, '^00|[^0-9]', '')"
    return _let(d, "d", f"if(length(d) between 8 and 15, {_let(_digits('substr(d, 4)', chr(39) + 'intl' + chr(39), key), 'b', _into(m, 'b'))}, {m})")


def _national(m: str, key: str) -> str:
    d = f"regexp_replace({m}, '[^0-9]', '')"
    return _let(d, "d", f"if(length(d) between 10 and 11, {_let(_digits('substr(d, 4)', chr(39) + 'national' + chr(39), key), 'b', _into(m, 'b'))}, {m})")


def _mod97(x: str) -> str:
    return f"aggregate(split({x}, ''), 0, (r, c) -> if(c rlike '[0-9]', (r * 10 + cast(c as int)) % 97, (r * 100 + ascii(c) - 55) % 97))"


def _iban(m: str, key: str) -> str:
    """Digits behind the check digits permuted among themselves, in place; then the check digits that fit."""
    bare, tail = f"upper(replace({m}, ' ', ''))", "concat(substr({0}, 5), substr({0}, 1, 2))"
    moved = _let("regexp_replace(substr(x, 5), '[^0-9]', '')", "d", f"if(d = '', {m}, {_let(_digits('d', chr(39) + 'iban' + chr(39), key), 'b', _into(m, 'b'))})")
    check = _let(f"concat({tail.format('y')}, '00')", "z", f"lpad(cast(98 - {_mod97('z')} as string), 2, '0')")
    fresh = _let(moved, "w", _let("upper(replace(w, ' ', ''))", "y", f"concat(substr(w, 1, 2), {check}, substr(w, 5))"))
    return _let(bare, "x", f"if({_mod97('concat(substr(x, 5), substr(x, 1, 4))')} = 1, {fresh}, {m})")


def _quoted(x: str) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _whole(kind: str) -> str:
    return _quoted(f"^(?:{FORMS[kind]})$")


def pseudonym(m: str, key: str) -> str:
    """SQL for the pseudonym of a match ``m``; a match that is not valid is returned as it is."""
    return (
        f"case when contains({m}, '@') then {_email(m, key)} when {m} rlike {_whole('ipv4')} then {_ipv4(m, key)} when {m} rlike {_whole('date')} then {_date(m, key)} "
        f"when {m} rlike {_whole('phone')} then {_phone(m, key)} when {m} rlike {_whole('ssn')} then {_ssn(m, key)} when {m} rlike '^([+]|00)' then {_intl(m, key)} when {m} rlike {_whole('national')} then {_national(m, key)} when {m} rlike '^[A-Za-z]' then {_iban(m, key)} else {_card(m, key)} end"
    )


def pseudonymised(docs: DataFrame, key: str, column: str = "text") -> DataFrame:
    """``docs`` with the text's validated values replaced under ``key``; all rows and columns stay, in place.

    Null stays null, an empty text empty. Equal values get equal pseudonyms in every row, and repeated rows come out
    alike. Values that fail validation (a card number's check digit, a day that does not exist) stay as they are. Long texts
    are read whole; an empty table gives no rows.
    """
    rows = _found(packed(docs, text=F.col(f"`{column}`").cast("string")), key)
    return unpacked(rows, docs.columns, **{column: F.col("new")})


def _found(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``matches`` of the column text, their ``pseudonyms``, and the ``new`` text."""
    pattern = _quoted(f"({_ALL})")
    rows = rows.withColumn("matches", F.expr(f"regexp_extract_all(text, {pattern}, 1)"))
    rows = rows.withColumn("pseudonyms", F.expr(f"transform(matches, m -> {pseudonym('m', _quoted(key))})"))
    parts = f"split(text, {_quoted(_ALL)}, -1)"
    return rows.withColumn("new", F.expr(f"if(size(matches) > 0, array_join(flatten(zip_with({parts}, pseudonyms, (p, q) -> array(p, coalesce(q, '')))), ''), text)"))


def session_key(spark: SparkSession) -> str:
    return spark.conf.get(KEY_SETTING, PUBLIC_KEY)


def op3_pii_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per row of documents: doc_id, text with pseudonyms, n_found (matches), n_replaced (values that changed)."""
    docs = _found(columns(table(spark, sf_dir, "documents"), doc_id="long", text="string"), session_key(spark))
    changed = F.expr("cast(size(filter(zip_with(matches, pseudonyms, (a, b) -> a <> b), x -> x)) as bigint)")
    return docs.select("doc_id", F.col("new").alias("text"), F.greatest(F.size("matches"), F.lit(0)).cast("long").alias("n_found"), F.coalesce(F.greatest(changed, F.lit(0)), F.lit(0)).cast("long").alias("n_replaced"))
