"""Line-first cleaning: bad lines go first, then documents that have lost too much text.

All of it is built-in functions on arrays inside the row: nothing is exploded or shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import BLANKS, bind, text_of

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
KEEP_PERCENT = 50  # of its words that a document must still have after cleaning
SYMBOLS = "[#*$%&|<>]"
WINDOW = 3
PLACE_BITS = 24  # of a packed number: a window's place; the rest is a hash

# Phrases of page furniture and notices, by language; a dot stands for either apostrophe.
FURNITURE = {
    "en": ("all rights reserved", "privacy policy", "terms of use", "terms of service", "cookie", "javascript", "click here",
           "subscribe", "sign up", "log in", "copyright", "licensed under", "lorem ipsum", "powered by", "read more", "share this"),
    "de": ("alle rechte vorbehalten", "datenschutzerklärung", "nutzungsbedingungen", "impressum", "hier klicken", "newsletter abonnieren",
           "jetzt registrieren", "einloggen", "urheberrecht", "lizenziert unter", "weiterlesen", "mehr lesen", "beitrag teilen"),
    "fr": ("tous droits réservés", "politique de confidentialité", "conditions d.utilisation", "mentions légales", "cliquez ici", "abonnez-vous",
           "inscrivez-vous", "se connecter", "droits d.auteur", "sous licence", "lire la suite", "partager cet article"),
    "es": ("todos los derechos reservados", "política de privacidad", "condiciones de uso", "términos de uso", "aviso legal", "haga clic aquí", "haz clic aquí",
           "suscríbete", "regístrate", "iniciar sesión", "derechos de autor", "bajo licencia", "leer más", "compartir en"),
}
BOILERPLATE = tuple(phrase for phrases in FURNITURE.values() for phrase in phrases)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[{BLANKS}]+"), "")


def times(text: Column, pattern: str) -> Column:
    """How often a pattern occurs."""
    return F.size(F.split(text, pattern)) - 1


def repeat_words(words: Column) -> Column:
    """Words that lie in a window of three words found twice or more, first included.

    Windows are sorted by a hash with their place in the low bits; those next to an equal hash are
    candidates, and only these are compared by their words, so the count is exact. A text too long
    for the place bits has all its windows compared.
    """
    place = F.lit((1 << PLACE_BITS) - 1).cast("long")

    def window(w: Column, i: Column) -> list[Column]:
        return [F.get(w, i + k) for k in range(WINDOW)]

    def meets(sorted_: Column, x: Column, j: Column, part) -> Column:
        """True where the neighbour before or behind has the same ``part``."""
        before, behind = F.get(sorted_, j - 1), F.get(sorted_, j + 1)
        return F.coalesce(part(x) == part(before), F.lit(False)) | F.coalesce(part(x) == part(behind), F.lit(False))

    def candidates(w: Column, n: Column) -> Column:
        packed = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*window(w, i)).bitwiseAND(F.lit(-(1 << PLACE_BITS)).cast("long")).bitwiseOR(i.cast("long")))
        few = bind(F.sort_array(packed), lambda s: F.transform(
            F.filter(s, lambda x, j: meets(s, x, j, lambda y: F.shiftright(y, PLACE_BITS))), lambda x: x.bitwiseAND(place).cast("int")))
        return F.when(n - WINDOW <= place, few).otherwise(F.sequence(F.lit(0), n - WINDOW))

    def places(w: Column, n: Column) -> Column:
        named = F.transform(candidates(w, n), lambda i: F.struct(F.concat_ws(" ", *window(w, i)).alias("window"), i.alias("i")))
        return bind(F.sort_array(named), lambda s: F.sort_array(F.transform(F.filter(s, lambda x, j: meets(s, x, j, lambda y: y["window"])), lambda x: x["i"])))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda i, j: F.least(F.lit(WINDOW), i - F.coalesce(F.get(p, j - 1), F.lit(-WINDOW))).cast("long"))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b)

    return bind(words, lambda w: F.when(F.size(w) > WINDOW, bind(places(w, F.size(w)), covered)).otherwise(F.lit(0).cast("long")))


def good_line(line: Column) -> Column:
    """The rules for one line; a line without words is not good.

    Punctuation: many symbols, shouting marks, or no lower-case letter in three words or more.
    Navigation: menu separators between the words. Boilerplate: a short line with a phrase of page
    furniture in any of the languages of ``FURNITURE``, whatever the document's language, or the same few
    words over and over.
    """

    def judge(w: Column) -> Column:
        n = F.size(w)
        symbols = times(line, SYMBOLS) * 5 > n
        shouts = times(line, "!") * 2 > n
        capitals = (n >= 3) & ~line.rlike(r"\p{Ll}") & line.rlike(r"\p{Lu}{2}")
        menu = times(line, "[|»›•·]") * 5 > n
        furniture = (n <= 30) & F.lower(line).rlike("|".join(BOILERPLATE))
        stuck = (n >= 10) & (F.size(F.array_distinct(w)) * 3 < n)
        return (n > 0) & ~symbols & ~shouts & ~capitals & ~menu & ~furniture & ~stuck

    return bind(words_of(line), judge)


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_percent: int = KEEP_PERCENT) -> DataFrame:
    """Counts, verdict and cleaned text of every whole text.

    Columns: ``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``kept``, ``kept_words`` and ``cleaned`` (the good lines,
    each once, in order).

    A null or empty text has no words, fails the base rules and is not kept. Null and repeated
    ids and rows give a row each; an empty table gives none; other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return _judged(rows, keep_percent).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "kept_words", "cleaned")


def _judged(rows: DataFrame, keep_percent: int) -> DataFrame:
    """``rows`` (with ``text``) and the columns named in ``clean_lines``."""
    split = rows.withColumns({"words": words_of(F.col("text")), "lines": F.split("text", "\n")})
    worded = F.filter("lines", lambda x: x.rlike(f"[^{BLANKS}]"))
    counted = split.withColumns({
        "n_words": F.size("words").cast("long"),
        "word_chars": F.length(F.array_join("words", "")).cast("long"),
        "n_symbols": times(F.col("text"), SYMBOLS).cast("long"),
        "n_dup_lines": bind(worded, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeat_words(F.col("words")),
        "cleaned": F.array_join(F.array_distinct(F.filter("lines", good_line)), "\n"),
    })
    judged = counted.withColumns({
        "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        "kept_words": F.size(words_of(F.col("cleaned"))).cast("long"),
    })
    return judged.withColumn("kept", ~F.col("base_failed") & (100 * F.col("kept_words") >= keep_percent * F.col("n_words")))


def keep_clean(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars", keep_percent: int = KEEP_PERCENT) -> DataFrame:
    """The documents that are kept, with their cleaned texts; ``chars_col`` gets the new length.

    All columns of ``docs`` stay, whatever their names and order.
    """
    judged = _judged(docs.select(F.struct(F.col("*")).alias("row"), text_of(text_col).alias("text")), keep_percent).filter("kept")
    row = F.col("row").withField(f"`{text_col}`", F.col("cleaned"))
    if chars_col is not None and chars_col in docs.columns:
        row = row.withField(f"`{chars_col}`", F.length("cleaned").cast(docs.schema[chars_col].dataType))
    return judged.select(row.alias("row")).select("row.*")
