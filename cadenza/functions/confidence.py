"""Enrichment confidence scores (P8, Q9-Q12): sums of ``when`` terms.

Terms are added left to right in the order the source system adds them,
so the double results are bit-identical to a sequential sum.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: famous-artist lists -------------------------------------------
FAMOUS_4 = ["eagles", "queen", "led zeppelin", "guns n roses"]            # exact, lower-case
FAMOUS_5 = ["Eagles", "Queen", "Led Zeppelin", "Michael Jackson", "Bob Dylan"]  # exact, as written
FAMOUS_15 = ["eagles", "queen", "led zeppelin", "guns n roses", "michael jackson",
             "bob dylan", "john lennon", "nirvana", "stevie wonder", "aretha franklin",
             "jimi hendrix", "beach boys", "marvin gaye", "chuck berry", "beatles"]  # substrings
# ------------------------------------------------------------------------------------


def _present(c: Column) -> Column:
    """Python truthiness of a string: not null and not empty."""
    return c.isNotNull() & (c != "")


def _sum(base: float, terms: list[tuple[Column, float]]) -> Column:
    out = F.lit(base)
    for cond, w in terms:
        out = out + F.when(cond, F.lit(w)).otherwise(F.lit(0.0))
    return out


def data_confidence(track_genres: Column, energy: Column, valence: Column, tempo: Column,
                    popularity: Column, device: Column, location: Column, has_play: Column) -> Column:
    """P8 (shape A): completeness weights, capped at 1."""
    total = _sum(0.0, [(F.size(F.coalesce(track_genres, F.array())) > 0, 0.2), (energy.isNotNull(), 0.15),
                       (valence.isNotNull(), 0.15), (F.coalesce(tempo != 0, F.lit(False)), 0.1),
                       (popularity.isNotNull(), 0.1), (_present(device), 0.1), (_present(location), 0.1),
                       (has_play, 0.1)])
    return F.least(total, F.lit(1.0))


def production_confidence(title: Column, artist: Column, genre: Column, location: Column,
                          platform: Column) -> Column:
    """Q9: 0.5 + .2 title and artist + .1 genre + .1 location + .1 platform, cap 1."""
    return F.least(_sum(0.5, [(_present(title) & _present(artist), 0.2), (_present(genre), 0.1),
                              (_present(location), 0.1), (_present(platform), 0.1)]), F.lit(1.0))


def famous_confidence(title: Column, artist: Column, genre: Column, location: Column, platform: Column,
                      artist_name: Column) -> Column:
    """Q10: Q9 plus .1 when the artist name is one of four (case-blind, exact), cap 1."""
    base = _sum(0.5, [(_present(title) & _present(artist), 0.2), (_present(genre), 0.1),
                      (_present(location), 0.1), (_present(platform), 0.1),
                      (F.lower(artist_name).isin(*FAMOUS_4), 0.1)])
    return F.least(base, F.lit(1.0))


def simple_confidence(title: Column, artist: Column, artist_name: Column, platform: Column,
                      album: Column, release_year: Column) -> Column:
    """Q11: 0.5 + .2 + .1 artist name + .1 platform + .1 famous (5 exact) + .1 album and year, cap .95."""
    base = _sum(0.5, [(_present(title) & _present(artist), 0.2), (_present(artist_name), 0.1),
                      (_present(platform), 0.1), (artist_name.isin(*FAMOUS_5), 0.1),
                      (_present(album) & F.coalesce(release_year != 0, F.lit(False)), 0.1)])
    return F.least(base, F.lit(0.95))


def local_confidence(title: Column, artist: Column, genre: Column, artist_name: Column, platform: Column,
                     album: Column, release_year: Column) -> Column:
    """Q12: .5 + .15 + .1 genre + .1 artist + .05 platform + .1 famous (15, substring) + .05 album and year, cap .95."""
    name_l = F.lower(F.coalesce(artist_name, F.lit("")))
    famous = F.exists(F.array(*[F.lit(n) for n in FAMOUS_15]), lambda n: name_l.contains(n))
    base = _sum(0.5, [(_present(title) & _present(artist), 0.15), (_present(genre), 0.1),
                      (_present(artist_name), 0.1), (_present(platform), 0.05), (famous, 0.1),
                      (_present(album) & F.coalesce(release_year != 0, F.lit(False)), 0.05)])
    return F.least(base, F.lit(0.95))
