"""Accent-aware cleaning of review text with built-in expressions only."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters kept besides a-z.
ACCENTED_LETTERS = "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýÿ"

# Portuguese stopwords (unaccented spellings included on purpose).
PORTUGUESE_STOPWORDS = tuple(
    """
    de a o que e do da em um para com não uma os no se na por mais as dos como mas ao ele das à seu sua ou quando
    muito nos já eu também só pelo pela até isso ela entre era depois sem mesmo aos seus quem nas me esse eles você
    essa num nem suas meu às minha numa pelos elas qual nós lhe deles essas esses pelas este dele tu te vocês vos
    lhes meus minhas teu tua teus tuas nosso nossa nossos nossas dela delas esta estes estas aquele aquela aqueles
    aquelas isto aquilo estou estamos estao estive esteve estivemos estiveram estava estavamos estavam estivera
    estiveramos esteja estejamos estejam estivesse estivéssemos estivessem estiver estivermos estiverem hei há
    havemos hão houve houvemos houveram houvera houvéramos haja hajamos hajam houvesse houvéssemos houvessem houver
    houvermos houverem houverei houverá houveremos houverão houveria houveríamos houveriam sou somos são éramos eram
    fui foi fomos foram fora fôramos seja sejamos sejam fosse fôssemos fossem for formos forem serei será seremos
    serão seria seríamos seriam tenho tem temos têm tinha tínhamos tinham tive teve tivemos tiveram tivera tivéramos
    tenha tenhamos tenham tivesse tivéssemos tivessem tiver tivermos tiverem terei terá teremos terão teria teríamos
    teriam
    """.split()
)


def clean_text(
    col: Column | str,
    stopwords: Collection[str] = PORTUGUESE_STOPWORDS,
    letters: str = ACCENTED_LETTERS,
) -> Column:
    """Lower-case, strip tags, keep letters and blanks, squeeze blanks, drop stopwords.

    NULL or blank text gives NULL; text that holds nothing but stopwords or symbols gives ``''``. Stopwords are
    removed as whole tokens, which after the earlier steps is the same as whole-word matching. Blanks are spelled out
    in the letter class, because a plain character class is matched twice as fast as one that refers to another.
    """
    text = F.col(col) if isinstance(col, str) else col
    untagged = F.regexp_replace(F.lower(text), "<[^>]+>", "")
    lettered = F.regexp_replace(untagged, rf"[^a-z{letters} \t\n\x0B\f\r]", "")
    dropped = ["", *sorted(set(stopwords))]
    kept = F.filter(F.split(lettered, r"\s+"), lambda token: ~token.isin(*dropped))
    return F.when(F.trim(text) != "", F.array_join(kept, " "))


def mentions(cleaned: Column | str, phrase: str) -> Column:
    """Whether cleaned text holds ``phrase`` as whole words."""
    padded = F.concat(F.lit(" "), F.col(cleaned) if isinstance(cleaned, str) else cleaned, F.lit(" "))
    return padded.contains(f" {phrase} ")
