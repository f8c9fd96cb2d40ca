"""Text expressions: patterns, tagging rules and readability formulas.

All of them are built-in column expressions, usable on a column as well as on
the element of a higher-order function.
"""

from pyspark.sql import Column, functions as F

from readgrade import fixed as C

LETTERS = r"\p{L}"
# white space of any kind; the short class of the engines covers ASCII only
SPACE = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WORD = f"[{LETTERS}]+"
# private characters before a clitic and before the rest of a verb in front of one
CLITIC, STEM = "\uE000", "\uE001"
# a number keeps the points and commas between its digits
NUMBER = "[0-9]+(?:[.,][0-9]+)*"
TOKEN = f"{CLITIC}[{LETTERS}]*['’][{LETTERS}]+|{STEM}[{LETTERS}]+|[{LETTERS}]+|{NUMBER}|[^{LETTERS}0-9{SPACE}]"
# a word with its clitics counts once
WORD_OR_NUMBER = f"[{LETTERS}]+(?:{CLITIC}[{LETTERS}]*['’][{LETTERS}]+)*|{NUMBER}"
CLITIC_ENDS = "[nN]['’][tT]|['’](?i:" + "|".join(c[1:] for c in C.CLITICS if c[0] == "'") + ")"
SENTENCE = r"[^.!?]+[.!?]*|[.!?]+"
CUT = "\uE000\uE001"
# The same classes as the JVM reads them fastest: what is common in a text stands outside of the nested class and is compared first.
# Negated, a class of many ranges is gone through in full for every letter.
SPACES = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
SOLID = (r"[!-~[\x{A1}-\x{167F}[\x00-\x08\x0E-\x1F\x7F-\x{84}\x{86}-\x{9F}\x{1681}-\x{1FFF}\x{200B}-\x{2027}\x{202A}-\x{202E}"
         r"\x{2030}-\x{205E}\x{2060}-\x{2FFF}\x{3001}-\x{10FFFF}]]]")
LETTER = rf"[a-z[A-Z[{LETTERS}]]]"
# the alternatives of TOKEN start with different characters, so that their order is free; what is left is neither letter nor digit
FAST_TOKEN = f"{LETTER}+|{NUMBER}|{CLITIC}{LETTER}*['’]{LETTER}+|{STEM}{LETTER}+|{SOLID}"
FAST_WORD_OR_NUMBER = f"{LETTER}+(?:{CLITIC}{LETTER}*['’]{LETTER}+)*|{NUMBER}"
VOWEL_GROUP = "[aeiouyAEIOUYÀ-ÆÈ-ÏÒ-ÖØ-Ýà-æè-ïò-öø-ýÿ]+"
CHUNK_POS = ["DET", "ADJ", "NOUN", "PROPN"]


def strip(value: Column) -> Column:
    """Drop white space of any kind at both ends."""
    return F.trim(value, F.lit(SPACES))


def _last_word(words: list[str]) -> str:
    return f"(?i)(?:^|[^{LETTERS}])(?:{'|'.join(words)})[.]\\z"


# end of a piece and start of the next between which no sentence ends
JOINTS = [
    (r"[0-9][.]\z", "^[0-9]"),
    (f"(?:^|[^{LETTERS}])[{LETTERS}][.]\\z", f"^(?:[{LETTERS},;]|[{SPACE}]+[a-z0-9])"),  # U.S. and e.g.
    (f"(?:^|[^{LETTERS}])[A-HJ-Z][.]\\z", f"^[{SPACE}]+\\p{{Lu}}"),  # initials
    (_last_word(C.TITLES), f"^[{SPACE}]+[{LETTERS}]"),
    (_last_word(C.ABBREVIATIONS), f"^[{SPACE}]*[a-z0-9,;]"),
]
POSSIBLE_JOINT = f"(?i)(?:[0-9]|(?:^|[^{LETTERS}])(?:[{LETTERS}]|{'|'.join(C.TITLES + C.ABBREVIATIONS)}))[.]\\z"
TAIL = 12  # holds the longest of them with the character before


def sentences_in(text: Column) -> Column:
    """Pieces that end at full stops, question and exclamation marks, joined again where a point belongs to a number or a short form.

    Only the end of each piece is looked at. Texts without such an end keep their pieces; in the others the ends that count get
    a mark, and the whole is split at the marks: in proportion to the text, whatever its length.
    """
    def possible(piece):
        return piece.endswith(".") & F.substring(piece, -TAIL, TAIL).rlike(POSSIBLE_JOINT)

    def joint(piece, following):
        end, hit = F.substring(piece, -TAIL, TAIL), F.lit(False)
        for before, after in JOINTS:
            hit = hit | (end.rlike(before) & following.rlike(after))
        return possible(piece) & F.coalesce(hit, F.lit(False))

    def joined(pieces):
        marked = F.transform(pieces, lambda p, i: F.when(joint(p, F.get(pieces, i + 1)), p).otherwise(F.concat(p, F.lit(CUT))))
        return F.when(F.exists(pieces, possible), F.split(F.array_join(marked, ""), CUT)).otherwise(pieces)

    return F.get(F.transform(F.array(F.regexp_extract_all(text, F.lit(SENTENCE), 0)), joined), F.lit(0))


def clitics_apart(text: Column) -> Column:
    """A private character before each clitic; only texts with an apostrophe are searched."""
    marked = F.regexp_replace(text, f"(?<=[{LETTERS}])({CLITIC_ENDS})(?![{LETTERS}])", f"{CLITIC}$1")
    marked = F.regexp_replace(marked, f"(?i)(?<![{LETTERS}])({'|'.join(C.CLITIC_STEMS)})(?={CLITIC}n['’]t)", f"{STEM}$1")
    return F.when(text.contains("'") | text.contains("’"), marked).otherwise(text)


def matches(value: Column, pattern: str) -> Column:
    return F.regexp_count(value, F.lit(pattern)).cast("bigint")


# The tagging rules work on the code point of the first character and on the last
# letters of a word. Whole numbers and short strings keep the generated code of the
# token stage under the size that the JVM still compiles.

def first_code(word: Column) -> Column:
    return F.ascii(word)


def plain(marked: Column) -> Column:
    """A token without the private character in front of it."""
    code = first_code(marked)
    return F.when(code.isin(ord(CLITIC), ord(STEM)) & (F.length(marked) > 1), F.substring(marked, 2, 1 << 30)).otherwise(marked)


def plain_lower(marked: Column, word: Column) -> Column:
    """In small letters, clitics with a straight apostrophe."""
    return F.when(is_clitic(first_code(marked)), F.replace(F.lower(word), F.lit("’"), F.lit("'"))).otherwise(F.lower(word))


def is_clitic(code: Column) -> Column:
    return code == ord(CLITIC)


def is_stem(code: Column) -> Column:
    return code == ord(STEM)


def is_letter(code: Column, word: Column) -> Column:
    """A token holds letters only or none, so its first character decides; of other scripts only a single character needs a look."""
    other = (code > 127) & (code != ord(CLITIC)) & ((F.length(word) > 1) | word.rlike(f"[{LETTERS}]"))
    return code.between(65, 90) | code.between(97, 122) | other


def is_capital(code: Column, word: Column) -> Column:
    first = F.substring(word, 1, 1)
    return code.between(65, 90) | ((code > 127) & (F.lower(first) != first))


def is_digit(code: Column) -> Column:
    return code.between(48, 57)


def tail(lower: Column, size: int) -> Column:
    return F.substring(lower, -size, size)


def _endings(tags: list[str]) -> dict[int, list[tuple[str, list[str]]]]:
    """Endings of the classes by their length, in the order of the fixed table."""
    found: dict[int, list[tuple[str, list[str]]]] = {}
    for tag, endings in C.OPEN_CLASS_SUFFIXES:
        for e in endings if tag in tags else []:
            rows = found.setdefault(len(e), [])
            if not rows or rows[-1][0] != tag:
                rows.append((tag, []))
            rows[-1][1].append(e)
    return found


def suffix_class(lower: Column, tails: dict[int, Column]) -> Column:
    """Class by ending; no listed ending is the end of another one, so their order does not matter."""
    expr = None
    for size, rows in _endings([t for t, _ in C.OPEN_CLASS_SUFFIXES]).items():
        for tag, endings in rows:
            hit = tails[size].isin(endings)
            expr = F.when(hit, tag) if expr is None else expr.when(hit, tag)
    return F.when(F.length(lower) >= C.MIN_SUFFIX_WORD, expr)


def part_of_speech(code: Column, letter: Column, capital: Column, lower: Column, tails: dict[int, Column], position: Column,
                   closed: Column, before_closed: Column) -> Column:
    """Closed class, then a capital inside the sentence, then the ending; 's after a pronoun is a verb."""
    known = F.coalesce(closed, F.when(is_stem(code), "AUX"), F.when((position > 0) & capital, "PROPN"), suffix_class(lower, tails), F.lit("NOUN"))
    attached = F.when((lower == "'s") & (before_closed == "PRON"), "AUX").otherwise(closed)
    return F.when(letter, known).when(is_clitic(code), attached).when(is_digit(code), "NUM").otherwise("PUNCT")


def lemma(lower: Column, tails: dict[int, Column], pos: Column) -> Column:
    """Strip verb endings from verbs and plural endings from nouns."""
    size = F.length(lower)
    verb = (F.when(size < C.MIN_SUFFIX_WORD, 0).when(tails[3] == "ing", 3).when(tails[2] == "ed", 2).otherwise(0))
    plural = (F.when((size < 4) | ~lower.endswith("s") | tails[2].isin("ss", "us", "is"), 0)
              .when(tails[3] == "ies", 3)
              .when(tails[4].isin("sses", "shes", "ches") | (tails[3] == "xes"), 2).otherwise(1))
    cut = F.when(pos == "VERB", verb).when(pos == "NOUN", plural).otherwise(0)
    stem = F.substring(lower, F.lit(1), size - cut)
    return F.when((pos == "NOUN") & (cut == 3), F.concat(stem, F.lit("y"))).otherwise(stem)


def in_chunk(pos: Column) -> Column:
    """Noun chunks are runs of these word classes."""
    return pos.isin(CHUNK_POS)


def word_in_chunk(letter: Column, capital: Column, lower: Column, position: Column, closed: Column) -> Column:
    """``in_chunk`` of a word, without spelling out its whole part of speech.

    Among the open classes only adverbs and verbs stay outside a chunk.
    """
    ending = F.lit(False)
    for size, rows in _endings(["ADV", "VERB"]).items():
        ending = ending | tail(lower, size).isin([e for _, endings in rows for e in endings])
    open_class = ((position > 0) & capital) | (F.length(lower) < C.MIN_SUFFIX_WORD) | ~ending
    return letter & F.when(closed.isNotNull(), in_chunk(closed)).otherwise(open_class)


# ---- formulas over a whole text, no shuffle --------------------------------

def word_total(text: Column) -> Column:
    return matches(clitics_apart(text), FAST_WORD_OR_NUMBER)


def sentence_total(text: Column) -> Column:
    """Sentences that hold a letter or digit."""
    return F.size(F.filter(sentences_in(text), lambda s: s.rlike(f"[{LETTERS}0-9]"))).cast("bigint")


def letter_total(text: Column) -> Column:
    return F.length(F.regexp_replace(text, f"[^a-zA-Z0-9{LETTERS}]+", "")).cast("bigint")


def whitespace_words(text: Column) -> Column:
    return matches(text, f"{SOLID}+")


def full_stop_pieces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit("."), F.lit(""))) + 1).cast("bigint")


def ari(letters: Column, words: Column, sentences: Column) -> Column:
    """Senter & Smith 1967; 0 where the text has no word."""
    score = 4.71 * (letters / words) + 0.5 * (words / sentences) - 21.43
    return F.when((words > 0) & (sentences > 0), score).otherwise(0.0)


def flesch(words: Column, sentences: Column, syllables: Column) -> Column:
    """Flesch 1948."""
    score = 206.835 - 1.015 * (words / sentences) - 84.6 * (syllables / words)
    return F.when((words > 0) & (sentences > 0), score).otherwise(0.0)


def coleman_liau(letters: Column, words: Column, sentences: Column) -> Column:
    """Coleman & Liau 1975."""
    score = 0.0588 * (letters * 100.0 / words) - 0.296 * (sentences * 100.0 / words) - 15.8
    return F.when(words > 0, score).otherwise(0.0)


def ari_of(text: Column) -> Column:
    return ari(letter_total(text), word_total(text), sentence_total(text))


# ---- frequency ---------------------------------------------------------------

def zipf(n: Column, total: Column) -> Column:
    """log10 of the frequency per billion words (van Heuven et al. 2014)."""
    return F.log10(n.cast("double") * 1e9 / total.cast("double"))


def rank_from_zipf(value: Column) -> Column:
    power = F.pow(F.lit(10.0), F.least(F.greatest(7.0 - value, F.lit(0.0)), F.lit(7.0)))
    rank = F.least(F.greatest(F.bround(power), F.lit(1.0)), F.lit(float(C.FALLBACK_RANK)))
    return F.when(value > 0, rank.cast("bigint")).otherwise(F.lit(C.FALLBACK_RANK).cast("bigint"))


def level_from_zipf(surface: Column, base: Column) -> Column:
    value = F.coalesce(F.nullif(surface, F.lit(0.0)), base, F.lit(0.0))
    expr = None
    for cut, level in C.FREQUENCY_LEVEL_CUTS:
        expr = F.when(value >= cut, level) if expr is None else expr.when(value >= cut, level)
    return expr.otherwise("C2")


def inverse_zipf(value: Column, readability: Column | None = None) -> Column:
    """``10 - zipf``; without frequency data ``10 - ARI``, never below 0."""
    return 10.0 - F.coalesce(value, F.lit(0.0)) if readability is None else F.greatest(F.lit(0.0), 10.0 - readability)


def inverse_zipf_or_none(value: Column) -> Column:
    return F.when(value.isNotNull(), inverse_zipf(value))


def level_score(level: Column, unknown: int | None) -> Column:
    expr = None
    for name, score in C.LEVEL_SCORES:
        expr = F.when(level == name, score) if expr is None else expr.when(level == name, score)
    return expr.otherwise(F.lit(unknown)).cast("bigint")


def wordlist_level(label: Column) -> Column:
    """Upper case without blanks, cut to ``[ABC][12]`` where it starts like that."""
    clean = F.replace(F.upper(strip(label)), F.lit(" "), F.lit(""))
    head = F.regexp_extract(clean, "^([ABC][12])", 1)
    return F.when(head != "", head).otherwise(clean)


def literal_fill(template: Column, values: dict) -> Column:
    """Replace every ``{name}`` of ``template`` by its value."""
    for name, value in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), value)
    return template


def file_slug(value: Column) -> Column:
    """Name part for files: every run of other characters becomes one ``_``, 40 at most."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(value), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.when(F.length(plain) > 0, F.substring(plain, 1, 40)).otherwise("text")


def word_slug(value: Column) -> Column:
    """Name part for files: drop other characters, blanks become ``_``."""
    kept = F.regexp_replace(F.lower(strip(value)), "[^a-z0-9 _-]+", "")
    slug = F.regexp_replace(F.replace(kept, F.lit(" "), F.lit("_")), "_+", "_")
    return F.when(F.length(slug) > 0, slug).otherwise("text")
