"""Names of targets: one table says which spellings mean which code; the Python and the column functions read it alike."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.functions.terms import Automaton
from docloom.functions.text import compact, compact_text, nfkc_text

# Families of codes and spellings of targets, in the order in which they are tried.
FAMILIES = (
    ("CYP", "1A2 2A6 2B6 2C8 2C9 2C19 2D6 2E1 3A4 3A5 3A7 3A"),
    ("UGT", "1A1 1A3 1A4 1A6 1A9 1A10 2B4 2B7 2B10 2B15 2B17"),
)
SPELLINGS = {
    "P-GLYCOPROTEIN": "P-gp", "PGLYCOPROTEIN": "P-gp", "P-糖蛋白": "P-gp", "P糖蛋白": "P-gp", "P-GP": "P-gp", "PGP": "P-gp", "BCRP": "BCRP",
    "OATP1B1": "OATP1B1", "OATP1B3": "OATP1B3", "OATP2B1": "OATP2B1", "OAT1": "OAT1", "OAT3": "OAT3", "OCT1": "OCT1", "OCT2": "OCT2",
    "MATE1": "MATE1", "MATE2-K": "MATE2-K", "MATE2K": "MATE2-K", "QTC": "QTc", "QT": "QT", "HERG": "hERG", "IKR": "IKr",
}
EVIDENCE = {"P-gp": ("p-gp", "pgp", "p糖蛋白", "p-糖蛋白", "p-glycoprotein"), "BCRP": ("bcrp",), "MATE2-K": ("mate2-k", "mate2k")}
# End of fixed values.


class TargetTable:
    """families: (prefix, members parted by spaces), whose first occurrence in a text counts; then spellings, the first listed.

    evidence: for some codes the spellings that support them; others are supported by the code itself.
    """

    def __init__(self, families: Sequence[tuple[str, str]] = FAMILIES, spellings: dict[str, str] | None = None, evidence: dict[str, Sequence[str]] | None = None) -> None:
        self.families = [(p, m.split()) for p, m in families]
        self.spellings = SPELLINGS if spellings is None else spellings
        self.evidence = EVIDENCE if evidence is None else evidence
        rows = [(g, True, p + m, p + m) for g, (p, members) in enumerate(self.families) for m in members]
        rows += [(len(self.families) + i, False, s, code) for i, (s, code) in enumerate(self.spellings.items())]
        self._rows = rows
        self._automaton = Automaton([spelling for _, _, spelling, _ in rows])
        self._by_fold = {c.casefold(): c for c in self.evidence}

    def find(self, text: str) -> str | None:
        """The code that a text names; spaces and case don't matter."""
        best = None
        for start, i in self._automaton.matches(nfkc_text(text).upper().replace(" ", "")):
            group, placed, _, code = self._rows[i]
            rank = (group, start if placed else 0, i)
            if best is None or rank < best[0]:
                best = rank, code
        return best[1] if best else None

    def find_column(self, text: Column, otherwise: Column) -> Column:
        """find() for texts in normal form; where nothing is named, otherwise, if it isn't empty."""
        up = F.replace(F.upper(text), F.lit(" "), F.lit(""))
        quote = lambda s: re.sub(r"([^\w])", r"\\\1", s)
        told = [F.nullif(F.regexp_extract(up, f"{quote(p)}(?:{'|'.join(map(quote, members))})", 0), F.lit("")) for p, members in self.families]
        told += [F.when(F.contains(up, F.lit(s)), F.lit(code)) for s, code in self.spellings.items()]
        return F.coalesce(*told, F.nullif(otherwise, F.lit("")))

    def names(self, code: str | None, name: str | None) -> list[str]:
        """Compact spellings of which any supports a code or a name."""
        known = self.evidence.get(self._by_fold.get((code or "").casefold(), ""), (code,) if code else ())
        return [t for t in map(compact_text, (*known, *((name,) if name else ()))) if t]

    def supported(self, evidence: str, code: str | None, name: str | None) -> bool:
        """Whether the evidence has a spelling; case, white space, hyphens and middle dots don't matter."""
        tight = compact_text(evidence)
        return any(t in tight for t in self.names(code, name))

    def supported_column(self, evidence: Column, code: Column, name: Column) -> Column:
        """supported() for texts in normal form."""
        tight, own = compact(evidence), compact(code)
        has = lambda word: (word != "") & F.contains(tight, word)
        by_code = has(own)
        for c, spellings in self.evidence.items():
            any_of = F.exists(F.array(*(F.lit(compact_text(s)) for s in spellings)), lambda w: F.contains(tight, w))
            by_code = F.when(F.lower(code) == c.lower(), any_of).otherwise(by_code)
        return F.coalesce(by_code, F.lit(False)) | F.coalesce(has(compact(name)), F.lit(False))


#: The table of the published notes.
TARGETS = TargetTable()
