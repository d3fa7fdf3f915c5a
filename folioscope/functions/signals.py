"""Text signals of one line as Spark SQL expressions.

Every function takes the SQL of its inputs and returns SQL: a line's text, its words (array), or one stripped word
(``core``). Letters are \\p{L}, alphanumerics \\p{L} and \\p{N}; words are split at Unicode white space. Ratios of an
empty denominator are 0. A null line gives null.
"""

from __future__ import annotations

from folioscope.params import (
    ABBREVIATION_CHAIN, CONTENTS_ENTRY, CZ_DIACS, DEFAULT, DEU_DIACS, DIMENSIONS, DOCUMENT_WORDS, DOUBLED_START, FUSED_GRID, GRID_PART, HEADINGS, IDENTIFIER, INTERNAL, JOINERS, LABELS, LDL_FOLLOW, LDL_UNITS, MEASURED, MEASURED_DOT, METADATA_MARKERS,
    NEUTRAL, NUMBER_REFERENCE, PARTS, PARTS_DOT, PIECE_COUNT, PLATE_REFERENCE, PLOT_HEADER, ROTATABLE, SHAPE_CLAUSES, SHORT_EXCEPTION, SHORT_VALID, SIGLUM, SINGLES, STRIP, TAXON_ENDINGS, TITLES, UNITS, UPRIGHT_WORDS, VOWELS, WORD_AND_CHAIN, Params, ghost_words,
)

SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
CZ_UPPER = "A-ZÁČĎÉĚÍŇÓŘŠŤŮÚÝŽ"
CZ_LOWER = "a-záčďéěíňóřšťůúýž"
LATIN = "A-Za-zÀ-ÖØ-öø-ſ"


#: A word of letters in plain case.
PLAIN = r"^\p{Lu}?\p{Ll}+$"


DIGIT = r"\p{Nd}"
#: Letters of Latin-1, which patterns test fastest: vowels (plain ones first), others, capitals; q, w and x are in none but ``_ANY``.
_V, _C, _UP, _LOW, _ANY = "aeiouyáéíóúýäöü", "bcdfghjklmnprstvzßàâãåæçèêëìîïðñòôõøùûþÿ", "A-PR-VYZÀ-ÖØ-Þ", "a-zß-öø-ÿ", "[A-Za-zÀ-ÖØ-öø-ÿ]"
#: A plain word of two letters, and words that are well-formed whatever stands around them: too long for an abbreviation, or not closed like one.
PAIR = f"[{_UP}{_V}{_C}][{_V}{_C}][.,;:!?]?"
SURE = f"(?:[A-ZÀ-ÖØ-Þ]?[{_LOW}]{{5,}}[.,;:!?]?|(?![dD]kg[,;!?]?(?![^ ]))(?:[A-ZÀ-ÖØ-Þ][{_LOW}]{{2,4}}|[{_LOW}]{{3,4}})[,;!?]?)"


def plain_word(p: Params) -> str:
    """Pattern of the commonest words, which have none of the faults that signals look for: 2 to 13 letters, in lower case but for the first, without q, w
    and x; from three on some vowel, no run of vowels or consonants that looks fused, no doubled letter but o and u, no letter three times, and consonants
    enough not to be gibberish. With constants that these bounds do not cover, no word is plain."""
    if p.vowel_high < 0.70 or p.fused_vowels < 3 or p.wx_repeat < 1:
        return "(?!)"
    rest, single = f"[{_V}A-ZÀ-ÖØ-Þ]*+[{_C}]", "a-np-tv-zß-öø-ÿ"
    enough = "|".join(f"(?={_ANY}{{{a},{b}}}(?!{_ANY}))(?:{rest}){{{k}}}" for a, b, k in ((4, 6, 2), (7, 10, 3), (11, 13, 4)))
    faults = f"(?!{_ANY}*[{_V}{_V.upper()}]{{{p.fused_vowels}}})(?!{_ANY}*[{_C}A-ZÀ-ÖØ-Þ][{_C}]{{4}})(?!{_ANY}*([{single}])\\1)(?!{_ANY}*([{single}]){_ANY}*\\2{_ANY}*\\2)"
    return f"(?:{PAIR}(?![^ ])|(?=[{_UP}]?[{_V}{_C}]{{2,13}}[.,;:!?]?(?![^ ]))(?={_ANY}*[aeiouyáéíóúý])(?={_ANY}{{3}}(?!{_ANY})|{enough}){faults}{_ANY}{{3,}}[.,;:!?]?)"


def lit(x: str) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def klass(chars: str) -> str:
    return "[" + "".join("\\" + c if c in "\\]^-[&" else c for c in chars) + "]"


def array_of(values) -> str:
    return f"array({', '.join(map(lit, values))})"


def let(value: str, name: str, body: str) -> str:
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def rlike(x: str, pattern: str) -> str:
    return f"({x} rlike {lit(pattern)})"


def n_of(x: str, pattern: str) -> str:
    """How many characters match a pattern of one character. Runs are taken out and lengths compared: an array of all matches costs far more."""
    return f"(length({x}) - length(regexp_replace({x}, {lit(pattern + '++')}, '')))"


def ratio(a: str, b: str) -> str:
    return f"coalesce(try_divide(cast({a} as double), {b}), 0D)"


def words(text: str) -> str:
    return f"filter(split({text}, {lit(SPACE + '+')}), w -> w <> '')"


def stripped(word: str, chars: str = STRIP) -> str:
    return f"trim(BOTH {lit(chars)} FROM {word})"


def cores(word_array: str) -> str:
    return f"transform({word_array}, w -> {stripped('w')})"


def subtokens(word: str) -> str:
    return f"filter(split({word}, {lit('[.–-]')}), x -> x <> '')"


def garbage_density(t: str) -> str:
    return ratio(n_of(t, r"[^\p{L}\p{N} ]"), f"length({t})")


def symbol_ratio(t: str) -> str:
    return ratio(n_of(t, r"[^\p{L}\p{N}\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"), f"length({t})")


def digit_ratio(t: str) -> str:
    return ratio(n_of(t, r"\p{Nd}"), f"length({t})")


def vowel_ratio(t: str) -> str:
    symbols = n_of(t, r"[^\p{L}\p{N}\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
    return ratio(n_of(t, klass(VOWELS)), f"({n_of(t, r'\p{L}')} + {symbols})")


def rotatable_ratio(t: str) -> str:
    return ratio(n_of(f"lower({t})", klass(ROTATABLE)), n_of(t, r"\p{L}"))


def has_diacritics(t: str) -> str:
    return rlike(t, klass(CZ_DIACS))


def diacritic_language(t: str, threshold: float = 0.07) -> str:
    """ces or deu where the share of its marked letters is high enough, else null."""
    share = lambda chars: ratio(n_of(t, klass(chars)), n_of(t, r"\p{L}"))
    return f"case when not {rlike(t, r'\p{L}')} then null when {share(CZ_DIACS)} >= {threshold}D then 'ces' when {share(DEU_DIACS)} >= {threshold}D then 'deu' end"


def strange(core: str) -> str:
    """A symbol that may not stand inside a word."""
    return rlike(core, r"[^\p{L}\p{N}" + klass(INTERNAL)[1:])


def strange_symbols(w: str) -> str:
    inside = n_of("x", r"[^\p{L}\p{N}" + klass(INTERNAL)[1:])
    return f"aggregate({cores(w)}, 0, (s, x) -> s + {inside})"


def is_upper(c: str) -> str:
    """Some cased letter, and none in lower case."""
    return f"({c} = upper({c}) and {rlike(c, r'[\p{Lu}\p{Lt}]')} and not {rlike(c, r'\p{Ll}')})"


def is_title(core: str) -> str:
    return f"array_contains({array_of(TITLES)}, rtrim('.', {core}))".replace(f"rtrim('.', {core})", f"trim(TRAILING '.' FROM {core})")


def mid_uppercase(core: str) -> str:
    inner = rlike(core, r"^\p{Lu}{2,}.*\p{Ll}") + " or " + rlike(core, r"\p{Ll}\p{Lu}")
    return f"(length({core}) >= 2 and not {is_upper(core)} and not {is_title(core)} and ({inner}))"


def starting_uppercase(core: str) -> str:
    return f"(length({core}) >= 2 and not {is_upper(core)} and not {is_title(core)} and {rlike(core, r'^\p{Lu}\p{Lu}')})"


def doubled(core: str) -> str:
    """A tripled character, or a doubled one but o and u."""
    return f"({rlike(core, r'(\P{Nd})\1\1')} or {rlike(core, r'([^\p{Nd}oOuU])\1')})"


def often(core: str, each: str = "c") -> str:
    """A character that makes up 30 % and stands three times; ``each`` names one inside and hides a column of that name."""
    thrice = rlike(core, r"([^\p{Nd}oOuU]).*\1.*\1")
    return f"({thrice} and exists(array_distinct(split({core}, '')), {each} -> {each} <> '' and not {rlike(each, r'[\p{Nd}oOuU]')} and (length({core}) - length(replace({core}, {each}, ''))) >= 3 and (length({core}) - length(replace({core}, {each}, ''))) / length({core}) >= 0.30))"


def repeated_run(core: str) -> str:
    """A tripled character; a doubled one but o and u; or one that makes up 30 % and stands three times."""
    return f"(length({core}) >= 4 and ({doubled(core)} or {often(core)}))"


def letter_digit_letter(token: str) -> str:
    """A digit after a letter, or before something that may not follow one; units may."""
    units = "|".join(sorted(LDL_UNITS, key=len, reverse=True))
    follow = r"\p{Nd}(?![\p{Nd}\t-\r\x1c-\x20" + klass(LDL_FOLLOW)[1:] + rf"|(?i:{units})(?!\p{{L}})|$)"
    return f"({rlike(token, follow)} or {rlike(token, r'\p{L}\p{Nd}')})"


def count_words(w: str, test) -> str:
    return f"size(filter({w}, w -> {test}))"


def parts(w: str) -> str:
    """Array of each word's stripped subtokens."""
    return f"transform({w}, w -> transform({subtokens('w')}, x -> {stripped('x')}))"


def any_subtoken(test) -> str:
    return f"exists(w, x -> {test})"


def repeated_words(w: str) -> str:
    """These and the next counts take the array of ``parts``."""
    return count_words(w, any_subtoken(repeated_run("x")))


def gibberish_words(w: str, p: Params = DEFAULT) -> str:
    few_marks = f"{n_of('x', r'[\p{Nd}./,;:-]')} / length(x) < 0.6"
    much = f"{ratio(n_of('x', klass(VOWELS)), n_of('x', r'\p{L}'))} > {p.vowel_high}D"
    return count_words(w, any_subtoken(f"length(x) >= 4 and not {is_upper('x')} and {few_marks} and {rlike('x', r'\p{L}')} and {much}"))


def fused_words(w: str, p: Params = DEFAULT) -> str:
    runs = f"{rlike('lower(x)', '[bcčdfghjklmnpqrřsštvwxzž]{5,}')} or {rlike('lower(x)', f'[aeiouyáéíóúýěůäöü]{{{p.fused_vowels},}}')}"
    return count_words(w, any_subtoken(f"{rlike('x', r'\p{L}')} and (length(x) > 14 or {runs})"))


def wx_words(w: str, p: Params = DEFAULT) -> str:
    return count_words(w, any_subtoken(f"{n_of('x', '[wW]')} >= {p.wx_repeat} or {n_of('x', '[xX]')} >= {p.wx_repeat}"))


def ldl_words(w: str) -> str:
    return count_words(w, letter_digit_letter("w"))


def mid_uppercase_words(w: str) -> str:
    return f"size(filter(transform({w}, w -> {stripped('w', '.,;:!?()[]\"' + chr(39) + '-/')}), x -> {mid_uppercase('x')}))"


def all_caps(w: str) -> str:
    return let(f"filter({w}, w -> {rlike('w', r'\p{L}')})", "a", f"size(a) > 0 and forall(a, w -> {is_upper('w')})")


def symbol_letter_digit(word: str) -> str:
    return f"({rlike(word, r'\p{L}')} and {rlike(word, r'\p{Nd}')} and {rlike(word, r'[^\p{L}\p{N}\t-\r\x1c-\x20' + klass(INTERNAL)[1:])})"


def plain_words(t: str) -> str:
    """Lower-case runs of letters, digits and underscore."""
    return f"filter(split(lower({t}), {lit(r'[^\p{L}\p{N}_]+')}), w -> w <> '')"


def whole(values) -> str:
    """Pattern of the values as whole ``plain_words``."""
    return f"{BEGIN}(?:{'|'.join(values)}){END}"


def upright(t: str) -> str:
    return f"({has_diacritics(t)} or {rlike(f'lower({t})', whole(UPRIGHT_WORDS))})"


def ghost_hits(t: str) -> str:
    return f"regexp_count(lower({t}), {lit(whole(ghost_words()))})"


def ghost_dominated(t: str, p: Params = DEFAULT, hits: str | None = None) -> str:
    hits = hits or ghost_hits(t)
    return f"({hits} > 0 and {hits} / size({plain_words(t)}) >= {p.ghost_share})"


def word_weirdness(word: str) -> str:
    """0 to 1: how malformed one word is."""
    wqx = rlike("c", "[wqxWQX]")
    caps = f"length(c) >= 4 and not {is_upper('c')} and not {is_title('c')} and {rlike('c', r'^\p{Lu}{2,}.*\p{Ll}')}"
    vowelless = f"{n_of('c', r'\p{L}')} >= 3 and not {rlike('c', klass(VOWELS))} and not {is_title('c')}"
    weigh = lambda *terms: " + ".join(f"if({test}, {weight}D, 0D)" for weight, test in terms)
    of_form = weigh((0.40, strange("c")), (0.15, letter_digit_letter("c")), (0.25, mid_uppercase("c")), (0.20, caps))
    # letters in plain case have none of the faults of form; most words end there
    total = f"{weigh((0.35, repeated_run('c')), (0.20, wqx), (0.50, vowelless))} + if({rlike('c', PLAIN)}, 0D, {of_form})"
    single = f"case when {rlike('c', klass(SINGLES))} or contains({word}, '.') then 0D when {rlike('c', r'^\p{Nd}$')} then 0.25D when not {rlike('c', r'^\p{L}$')} then 0D else 0.85D end"
    return let(stripped(word), "c", f"case length(c) when 0 then 0D when 1 then {single} else least(1D, {total}) end")


def is_fragment(word: str) -> str:
    return let(stripped(word), "c", f"length(c) <= 2 or {rlike('c', r'^\p{Nd}+$')}")


def pairs(line: str, p: Params = DEFAULT) -> str:
    """How many plain words of two letters a line of words between single blanks has."""
    return f"regexp_count({line}, {lit(f'(?<![^ ]){PAIR}(?![^ ])')})" if plain_word(p) != "(?!)" else "0"


def fragment_ratio(w: str, of: str | None = None, more: str = "0") -> str:
    """This and the next: words of an array, as a share of all words ``of`` the line; ``more`` are fragments that the array lacks."""
    return ratio(f"(size(filter({w}, w -> {is_fragment('w')})) + {more})", f"size({of or w})")


def wqx_ratio(w: str, of: str | None = None) -> str:
    return ratio(f"size(filter({w}, w -> {rlike('w', '[wqxWQX]')}))", f"size({of or w})")


def line_weirdness(w: str, inverted: str, fragmented: str, p: Params = DEFAULT, odd: str | None = None) -> str:
    """Mean word weirdness; every word of an inverted line and the fragments of a fragmented one weigh more. In other lines only the
    words ``odd`` are read: plain ones weigh nothing."""
    read = w if odd is None else f"if({inverted} or {fragmented}, {w}, {odd})"
    s = word_weirdness("w")
    s = f"if({inverted}, least(1D, {s} + {p.inverted_penalty}D), {s})"
    s = let(s, "v", f"if({fragmented} and {is_fragment('w')}, least(1D, v + 0.35D), v)")
    return ratio(f"aggregate({read}, 0D, (a, w) -> a + {s})", f"size({w})")


def neutral_token(core: str, raw: str, following: str) -> str:
    """Initials, units, references and abbreviations count neither as words nor against them."""
    alpha = n_of(core, r"\p{L}")
    # one to five letters count, so five parts are the most; an unbounded repeat of a group would recurse for every part
    abbrev = rlike(f"trim(TRAILING ',;:-–—/)' FROM {raw})", r"\.$") + " and " + rlike(core, rf"^[{LATIN}]{{1,4}}(?:\.[{LATIN}]{{1,4}}){{0,4}}$")
    single = f"{alpha} = 1 and (({following} <> '' and ({rlike(following, r'\p{Nd}')} or {rlike(following, '^[IVXLCDM]{1,7}$')})) or {raw} like '%:')"
    return (
        f"(not {rlike(core, r'[\p{L}\p{N}]')} or {n_of(core, r'\p{Nd}')} / length({core}) >= 0.5 or {rlike(core, rf'^([{CZ_UPPER}]\.?){{1,3}}$')} or array_contains({array_of(NEUTRAL)}, lower({core})) "
        f"or {rlike(core, rf'^[{LATIN}]{{1,4}}[.,][0-9]+[a-z]?$')} or ({abbrev} and ({alpha} between 2 and 5 or {single})))"
    )


def words_but(line: str, pattern: str, after: bool = False) -> str:
    """Array of the words, of a line with single blanks between them, that do not match a pattern, or of the words ``after`` these, empty for the last; the
    pattern then has no groups.
    The line is read once, where a test in a lambda would decode its pattern again for every word."""
    return f"regexp_extract_all({line}, {lit(f'(?<![^ ])(?!{pattern}(?![^ ]))[^ ]+(?:(?= ([^ ]+))|)')}, {int(after)})"


def odd_words(line: str, p: Params = DEFAULT) -> str:
    """Array of the words that are not plain."""
    return words_but(line, plain_word(p))


def _validity(c: str, w: str, following: str) -> tuple[str, str]:
    """SQL for a word (stripped, and as it stands) that can be judged before what follows, and for a well-formed one."""
    two = rlike(w, f"^(?!(?:{'|'.join(n for n in NEUTRAL if len(n) == 2)})[,;!?]?$)[{_LOW}]{{2}}[,;!?]?$")  # nor is it any of what ``neutral_token`` spares
    short = f"{rlike(c, r'^\p{Lu}?\p{Ll}{2,4}$')} and length({c}) >= 3 and not {rlike(w, r'[.:]')} and not array_contains({array_of(NEUTRAL)}, lower({c}))"
    sure = f"({rlike(c, r'^\p{Lu}?\p{Ll}{5,}$')} or ({short}))"  # too long for an abbreviation, or not closed like one
    form = f"length({c}) >= 3 and {n_of(c, r'\p{L}')} / length({c}) >= 0.70 and not {strange(c)} and not {mid_uppercase(c)}"
    judged = f"({two} or {sure} or ({c} <> '' and not {neutral_token(c, w, following)}))"
    return judged, f"({sure} or array_contains({array_of(SHORT_VALID)}, lower({c})) or {rlike(c, '^' + klass(SINGLES) + '$')} or ({form}))"


def valid_ratio(w: str, line: str | None = None) -> str:
    """Share of well-formed words among those that can be judged; 1 where none can, 0 without words. Only those that are not ``SURE`` are looked at closely.
    ``line`` are the words with blanks between them."""
    line = line or f"array_join({w}, ' ')"
    item = f"zip_with(u, {words_but(line, SURE, after=True)}, (w, n) -> named_struct('c', {stripped('w')}, 'w', w, 'n', {stripped('n')}))"
    judged, good = _validity("x.c", "x.w", "x.n")
    judged = f"filter({item}, x -> {judged})"
    shares = let(judged, "j", f"named_struct('j', size(j) + size({w}) - size(u), 'g', size(filter(j, x -> {good})) + size({w}) - size(u))")
    ratio_ = let(words_but(line, SURE), "u", let(shares, "r", "if(r.j = 0, 1D, r.g / cast(r.j as double))"))
    return f"case when size({w}) = 0 then 0D else {ratio_} end"


def word_validity(w: str, c: str) -> dict[str, str]:
    """SQL of one word for ``valid_ratio``: nothing need be asked (``sure``), it can be judged where no number or numeral ``leads`` after it, and where one
    does, and it is well-formed."""
    judged, good = _validity(c, w, "''")
    return {"sure": rlike(w, f"^{SURE}(?![^ ])"), "judged": judged, "judged1": f"if({n_of(c, r'\p{L}')} = 1, {_validity(c, w, lit('1'))[0]}, {judged})", "good": good}


def damaged_tokens(w: str) -> str:
    """Words with damage at character level: marks, digits or capitals inside words, vowelless words."""
    vowelless = f"not {rlike('trim(TRAILING ' + lit(',;:') + ' FROM w)', r'\.$')} and {rlike('c', f'^[{CZ_LOWER}]{{3,}}$')} and not {rlike('c', '[aeiouyáéěíóúůýrl]')}"
    tests = (rlike("c", "[\\^»«■□¤§~<>#*@$©®™।]"), rlike("c", r"\p{L}[’‘]\p{L}"), rlike("c", rf"[{CZ_LOWER}]{{2}}\p{{Nd}}|\p{{Nd}}[{CZ_LOWER}]{{2}}"), f"length(c) >= 4 and not w like '%.' and {rlike('c', f'[{CZ_LOWER}][{CZ_UPPER}]')}", vowelless)
    fine = f"({rlike('c', PLAIN)} and {rlike('c', '[aeiouyáéěíóúůýrl]')})"
    return f"size(filter({w}, w -> {let(stripped('w'), 'c', f'not {fine} and c <> ' + lit('') + ' and (' + ' or '.join(f'({t})' for t in tests) + ')')}))"


#: Abbreviations that mark a catalogue or inventory reference, and units of measure.
REFERENCE = r"(?iu)\b(?:inv|kont|n[áa]l|obr|tab|neg)\b|\b(?:max|min)\.|č\.\s?(?:j|inv|pl)|inv\.\s?č|s\.\s?j\b"
#: Some word of a line with a reference, or with an address, holds this.
REFERRING, LINKING = r"(?iu)inv|kont|n[áa]l|obr|tab|neg|max\.|min\.|č\.|s\.", "[@:]|[wW][.]"
MEASURE = r"(?iu)\d\s?[.,]?\s?(?:mm|cm|km|kg|ml|ha)\b"
#: An address on the net stands somewhere; only that is asked, so that no part is read more than once.
URL = r"(?i)https?://\S|www\.[\w-]++\.\w{2}|\be-?mail\b\s*:|[\w.+-]@[\w-]++\.[\w.-]"
GRID = rf"^{GRID_PART}(?:[/\-]{GRID_PART}){{1,4}}$"
#: Where a word begins and ends.
BEGIN, END = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"


def one_of(values) -> str:
    """Pattern of the values; a dot in one, and a blank after it, may be missing."""
    return "(?:" + "|".join(v.replace(". ", r"\.?\s*").replace(".", r"\.?") if " " in v or v.endswith(".") else v for v in values) + ")"


def clean_reference(t: str, w: str) -> str:
    return f"({damaged_tokens(w)} = 0 and ({rlike(t, REFERENCE)} or {rlike(t, MEASURE)}))"


def measurement(t: str) -> str:
    """A named dimension, two measured parts, or a dimension's letter with a value; or a number with its unit."""
    low, digits = f"lower({t})", n_of(t, r"\p{Nd}")
    named = rlike(low, f"{BEGIN}(?:{one_of(MEASURED)}{END}|{one_of(MEASURED_DOT)}\\.)")
    parts = f"regexp_count({low}, {lit(f'{BEGIN}(?:{one_of(PARTS)}{END}|{one_of(PARTS_DOT)}' + chr(92) + '.)')})"
    valued = rlike(low, f"{BEGIN}{one_of(DIMENSIONS)}" + r"\.?\s*[:=-]\s*\p{Nd}")
    unit = rlike(low, BEGIN + r"\p{Nd}+(?:[.,]\p{Nd}+)?" + f"(?:\\s*{one_of(UNITS)}|m){END}")
    return f"({rlike(t, DIGIT)} and ({unit} or ({named} or {parts} >= 2) or ({digits} >= 2 and {valued})))"


def catalogue(t: str) -> str:
    """Sigla, plot headers, composed identifiers, plates with their items, numbers after an inventory's mark."""
    numbered = " or ".join(rlike(t, f"(?iU){x}") for x in (PLOT_HEADER, IDENTIFIER, PLATE_REFERENCE, NUMBER_REFERENCE))
    return f"({rlike(t, SIGLUM)} or ({rlike(t, DIGIT)} and ({numbered})))"


def dated(t: str) -> str:
    """A day and month with a year anywhere, or a word of letters and forms with a number."""
    day = rlike(t, BEGIN + r"\p{Nd}{1,2}\s*[./-]\s*\p{Nd}{1,2}(?:\s*[./-]\s*\p{Nd}{2,4})?" + END)
    year = rlike(t, f"{BEGIN}(?:18|19|20)\\p{{Nd}}{{2}}{END}")
    return f"({rlike(t, DIGIT)} and (({day} and {year}) or {rlike(t, f'(?iu){BEGIN}{one_of(DOCUMENT_WORDS)}{END}')}))"


def contents_entry(t: str) -> str:
    """A numbered heading that a page, or a short range of pages, ends."""
    return rlike(t, f"(?U){CONTENTS_ENTRY}")


def heading(t: str) -> str:
    return f"array_contains({array_of(HEADINGS)}, lower(trim(TRAILING ' :;.-–—' FROM {t})))"


def structured_shape(t: str) -> str:
    """What of ``structured`` needs the text alone, blanks collapsed."""
    return f"({catalogue(t)} or {measurement(t)} or {dated(t)} or {contents_entry(t)} or {heading(t)})"


def structured(t: str, w: str) -> str:
    """References, sigla, measurements, dates, lines of a table of contents, headings."""
    return f"({t} <> '' and ({clean_reference(t, w)} or {structured_shape(t)}))"


def folded(t: str) -> str:
    """Lower case without the marks of letters."""
    marked = "áàâäãåăąčćçďđéèêëěęíìîïĺľłňńñóòôöõőřŕšśşťţúùûüůűýÿžźż"
    plain = "aaaaaaaacccddeeeeeeiiiilllnnnoooooorrsssttuuuuuuyyzzz"
    return f"translate(lower({t}), '{marked}', '{plain}')"


def notation(t: str, linking: str | None = None) -> str:
    """Grid references, also after a known label; counts of pieces; chains of abbreviations; addresses on the net (``linking``: some word may hold one)."""
    letter = f"[{CZ_UPPER}{CZ_LOWER}]"
    labelled = rlike(t, rf"^{letter}{{3,20}}\s*:\s*{GRID_PART}(?:[/-]{GRID_PART}){{0,4}}$")
    label = folded(f"trim(substring_index({t}, ':', 1))")
    known = f"array_contains(transform({array_of(LABELS)}, x -> {folded('x')}), {label})"
    count = rlike(t, f"(?iU){PIECE_COUNT}")
    chain = f"({rlike(t, ABBREVIATION_CHAIN)} or {rlike(t, f'(?U){WORD_AND_CHAIN}')})"
    return f"(({rlike(t, GRID)} and {rlike(t, f'[{CZ_UPPER}0-9]')}) or ({labelled} and {known}) or {count} or {chain} or ({linking or rlike(t, LINKING)} and {rlike(t, URL)}))"


def shape_cut(t: str) -> str:
    """Array of the words, cut at marks that join them, as they stand."""
    return f"split({t}, {lit(SPACE[:-1] + klass(JOINERS)[1:] + '+')})"


def shape_piece(x: str) -> str:
    """Struct of a cut word (c) and its letters (a)."""
    return f"named_struct('c', {stripped(x)}, 'a', regexp_replace({stripped(x)}, '\\\\P{{L}}', ''))"


def shape_pieces(t: str) -> str:
    """Words, cut at marks that join them, as structs of the word (c) and its letters (a); blank ones are left out."""
    return f"filter(transform({shape_cut(t)}, x -> {shape_piece('x')}), x -> x.a <> '')"


def shape_suspect(x: str, p: Params = DEFAULT) -> str:
    """True of every cut word with ``shape_faults`` in some language, and of some others: one pattern of the word as it stands, then the variety of words of
    letters only."""
    run = f"[{VOWELS}]{{{min(p.witness_vowels, p.witness_vowels_exempt)}}}"
    odd = rlike(x, rf"{run}|(?iu:(\p{{L}})\1\1)|^{klass(STRIP)}*(?i:([bcdfghjklmnpqrstvwxz])\2)|\P{{L}}")
    few = f"length({x}) >= {p.witness_variety_letters} and size(array_distinct(split(lower({x}), ''))) - 1 <= length({x}) * {p.witness_variety}D"
    return f"(length({x}) >= {p.witness_letters} and ({odd} or ({few})))"


def shape_judged(x: str, p: Params = DEFAULT) -> str:
    """A piece long enough, and none of the words, numerals and names of families that may look odd."""
    spared = tuple(dict.fromkeys(NEUTRAL + SHORT_EXCEPTION + SHORT_VALID + tuple(w.lower() for w in p.witness_allowed)))
    taxon = f"(length({x}.a) >= 5 and {rlike(f'{x}.a', f'(?i){one_of(TAXON_ENDINGS)}$')})"
    return f"(length({x}.a) >= {p.witness_letters} and not array_contains({array_of(spared)}, lower({x}.c)) and not {rlike(f'{x}.a', '^[IVXLCDM]{1,7}$')} and not {taxon})"


def _shape_tests(x: str, p: Params, *runs: int) -> tuple[str, ...]:
    """Vowels in a row, as many as each of ``runs``; a letter three times; doubled at the start; few letters."""
    few = f"length({x}.a) >= {p.witness_variety_letters} and size(array_distinct(filter(split(lower({x}.a), ''), y -> y <> ''))) / length({x}.a) <= {p.witness_variety}"
    return (*(rlike(f"{x}.c", f"[{VOWELS}]{{{n},}}") for n in runs), f"length({x}.a) <= {p.witness_triple_letters} and {rlike(f'{x}.c', r'(?iu)(\p{L})\1\1')}", rlike(f"{x}.c", f"(?i){DOUBLED_START}"), few)


def _shape_exempt(lang: str, p: Params) -> str:
    return f"coalesce(array_contains({array_of(p.witness_exempt_langs)}, substring_index({lang}, '_', 1)), false)"


def shape_faults(x: str, lang: str, p: Params = DEFAULT) -> str:
    """Array of what makes a piece no word: many vowels in a row, a letter three times, doubled at the start, few letters."""
    most, exempt, *rest = _shape_tests(x, p, p.witness_vowels, p.witness_vowels_exempt)
    tests = (f"if({_shape_exempt(lang, p)}, {exempt}, {most})", *rest)
    return f"array_compact(array({', '.join(f'if({t}, {lit(n)}, null)' for n, t in zip(SHAPE_CLAUSES, tests, strict=False))}))"


#: What is asked of a word for the clauses of its line, whatever the language.
SHAPE_SUMS = ("vowel_run", "vowel_run_exempt", "triple", "initial_geminate", "low_variety")


def shape_tests(x: str, p: Params = DEFAULT) -> dict[str, str]:
    """SQL for each of ``SHAPE_SUMS`` of a piece."""
    return dict(zip(SHAPE_SUMS, _shape_tests(x, p, p.witness_vowels, p.witness_vowels_exempt), strict=True))


def shape_summed(t: str, lang: str, sums: str, p: Params = DEFAULT) -> str:
    """``shape_clauses`` of a line from the sums of its words."""
    runs = f"if({_shape_exempt(lang, p)}, {sums}.vowel_run_exempt, {sums}.vowel_run)"
    counts = (runs, *(f"{sums}.{k}" for k in SHAPE_SUMS[2:]))
    found = f"array_compact(array({', '.join(f'if({n} > 0, {lit(k)}, null)' for k, n in zip(SHAPE_CLAUSES, counts, strict=False))}))"
    return f"if({shape_veto(t)}, cast(array() as array<string>), {found})"


def shape_veto(t: str) -> str:
    """A reference to a grid with a letter after its numeral."""
    return rlike(f"trim({t})", FUSED_GRID)


def shape_clauses(t: str, lang: str, p: Params = DEFAULT) -> str:
    """Clauses that some piece of a line meets, in fixed order. Diacritics, structure and notation are the caller's to veto."""
    found = f"flatten(transform(filter({shape_pieces(t)}, x -> {shape_judged('x', p)}), x -> {shape_faults('x', lang, p)}))"
    return f"if({shape_veto(t)}, cast(array() as array<string>), array_intersect({array_of(SHAPE_CLAUSES)}, {found}))"


def has_marker(t: str) -> str:
    return f"exists(array(lower({t})), z -> {' or '.join(f'contains(z, {lit(m)})' for m in dict.fromkeys(m.lower() for m in METADATA_MARKERS))})"


def forgiven_headline(t: str, w: str, density: str, p: Params = DEFAULT) -> str:
    """A short caption of clean words, abbreviations and numbers, with some numbering or abbreviation."""
    c = "x.c"
    number = rlike(c, r"^\p{Nd}+$")
    abbrev = f"array_contains({array_of(SHORT_EXCEPTION)}, replace(replace(lower({c}), '.', ''), ',', '')) or {is_title(c)} or {has_marker('x.w')}"
    roman = f"length(trim(TRAILING '.' FROM {c})) >= 2 and {rlike(c, r'(?i)^[IVXLCDM]+\.?$')}"
    function = f"array_contains({array_of(SHORT_VALID)}, lower({c})) or {rlike(c, '^' + klass(SINGLES) + '$')}"
    clean = f"size({w}) >= 2 and length({c}) >= 3 and {n_of(c, r'\p{L}')} / length({c}) >= 0.70 and not {strange(c)} and not {mid_uppercase(c)} and {rlike(c, klass(VOWELS))}"
    kind = f"case when not {rlike(c, r'[\p{L}\p{N}]')} then '-' when {number} then if(length({c}) > {p.headline_digits}, 'bad', 'context') when {abbrev} then 'both' when {roman} then 'context' when {function} or ({clean}) then 'content' else 'bad' end"
    kinds = f"transform(transform({w}, w -> named_struct('c', {stripped('w')}, 'w', w)), x -> {kind})"
    verdict = "not array_contains(k, 'bad') and arrays_overlap(k, array('both', 'content')) and arrays_overlap(k, array('both', 'context'))"
    return f"(size({w}) between 1 and {p.headline_words} and {density} < {p.density_high} and {let(kinds, 'k', verdict)})"


def trailing_fill_rescued(t: str, valid: str, n_words: str, p: Params = DEFAULT, diacritics: str | None = None) -> str:
    """The fill has no letters, so what of the rest is asked of marks is asked of the whole."""
    fill = f"trim(TRAILING ' ._:-<–—' FROM {t})"
    return f"({valid} > 0 and (({n_words} <= 4 and length({t}) <= 25) or {diacritics or has_diacritics(t)}) and {let(fill, 'f', f'f <> {lit(str())} and f <> {t} and {garbage_density(chr(102))} < {p.density_high}')})"


def bigram_run(w: str) -> str:
    return f"exists({w}, w -> {rlike(stripped('w'), r'(\p{L}{2})\1\1')})"


def anchored(t: str, w: str, p: Params = DEFAULT) -> str:
    """Enough words of letters with vowels; short ones between blanks are found by one pattern, before words are cut out."""
    full = f"size(filter({cores(w)}, c -> length(c) >= {p.anchor_len} and {rlike('c', r'^\p{L}+$')} and {vowel_ratio('c')} >= {p.anchor_vowel})) >= {p.anchor_words}"
    if p.anchor_len > 3 or p.anchor_vowel > 0.1 or not 1 <= p.anchor_words <= 9:
        return full
    word = r"(?:^| )[A-Za-z](?=[a-z]{0,8}[aeiou])[a-z]{2,9}(?=[.,;:!?]?(?: |$))"
    return f"({rlike(t, f'(?:{word}.*?){{{p.anchor_words}}}')} or {full})"


def fragment_tokens(w: str) -> str:
    sizes = f"transform(filter({w}, w -> {stripped('w')} <> ''), w -> length({stripped('w')}) + if(w like '%.', 1, 0))"
    return let(sizes, "z", "size(z) > 0 and aggregate(z, 0, (a, x) -> a + x) / cast(size(z) as double) < 2.0")


def non_text(t: str) -> str:
    """Codes, stamps, page numbers and the like."""
    token = f"not contains({t}, ' ') and ({rlike(t, r'^[A-Za-z]{1,3}\d{3,}(?:/\d+)?$')} or ({rlike(t, '^[A-Za-z0-9]{5,}$')} and ({rlike(t, r'\d')} or ({is_upper(t)} and (contains({t}, 'X') or (length({t}) >= 10 and {vowel_ratio(t)} < 0.20))))))"
    spaced = f"contains({t}, ' ') and length({t}) <= 20 and {rlike(t, rf'^[{CZ_UPPER}{CZ_LOWER}]{{1,5}}[\s.\-]+\d')}"
    return f"(not {rlike(t, rf'^\d{{3}}\s\d{{2}}\s+[{CZ_UPPER}]')} and ({rlike(t, r'^[\d\s\-–—/:.,()%]+$')} or ({token}) or ({spaced}) or (length({t}) < 15 and {digit_ratio(t)} > 0.5)))"


def remapped_language(label: str, score: str, known, default: str = "ces", p: Params = DEFAULT, keep=("slk",)) -> str:
    """Struct (lang, score): unknown languages take the default's name and a capped score."""
    base = f"substring_index({label}, '_', 1)"
    suffix = f"substr({label}, length({base}) + 1)"
    cap = f"if({suffix} = '_Latn', {p.lang_remap}D, {p.lang_remap_far}D)"
    capped = cap if p.lang_remap_always else f"least({score}, {cap})"
    return f"case when array_contains({array_of(known)}, {base}) then named_struct('lang', {label}, 'score', cast({score} as double)) when array_contains({array_of(keep)}, {base}) then named_struct('lang', concat({lit(default)}, {suffix}), 'score', cast({score} as double)) else named_struct('lang', concat({lit(default)}, {suffix}), 'score', {capped}) end"


def quality_score(valid: str, ppl: str, length: str, weird: str, vowel: str, density: str, lang: str, gibberish: str, fused: str, p: Params = DEFAULT) -> str:
    """Weighted mean of nine normalised signals, less a penalty for short malformed lines; 0 to 1."""
    easy = f"({length} <= 12 and {weird} = 0 and {density} < {p.density_norm}D)"
    garbage = f"(1 - least({density} / {p.density_norm}D, 1D))"
    vowels = f"case when {vowel} < {p.vowel_low}D then {vowel} / {p.vowel_low}D when {vowel} > {p.vowel_high}D then greatest(0D, 1 - ({vowel} - {p.vowel_high}D) / {1 - p.vowel_high!r}D) else 1D end"
    terms = (
        f"{p.w_valid}D * {valid}", f"{p.w_weird}D * (1 - least({weird}, 1D))", f"{p.w_perplexity}D * (1 - least({ppl} / {p.ppl_max}D, 1D))", f"{p.w_length}D * least({length} / {p.length_max}D, 1D)",
        f"if({easy}, {p.w_garbage / 2}D * {garbage} + {p.w_garbage / 2}D, {p.w_garbage}D * {garbage})", f"{p.w_vowel}D * ({vowels})", f"{p.w_lang}D * coalesce({lang}, 0.5D)",
        f"{p.w_gibberish}D * (1 - least({gibberish}, 1D))", f"{p.w_fused}D * (1 - least({fused}, 1D))",
    )
    penalty = f"if({length} <= 12 and ({weird} > 0 or {density} >= {p.density_norm}D), {p.short_penalty}D, 0D)"
    return f"least(1D, greatest(0D, ({' + '.join(terms)}) / {p.total_weight!r}D - {penalty}))"
