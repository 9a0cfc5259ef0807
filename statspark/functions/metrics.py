"""Per-game and rolling metrics as column expressions. Per-game ones are 0 where nothing was done, rolling ones null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(x: Column, places: int) -> Column:
    """Round half away from zero; the nudge keeps decimal-looking ties of doubles on the right side."""
    return F.round(x + F.when(x < 0, -1e-9).otherwise(1e-9), places)


def apart(x: Column) -> Column:
    """x by a higher-order function, which keeps the projection that holds it out of Spark's whole-stage method.

    The JIT leaves methods of more than 8,000 bytes to the interpreter. A projection of many columns that stands apart is
    compiled in small methods. Take a light column: what is inside is evaluated without generated code.
    """
    return F.transform(F.array(x), lambda v: v)[0]


def _guarded(base: Column, value: Column) -> Column:
    return F.when(base == 0, 0.0).otherwise(value)


def _double(x: Column) -> Column:
    return x.cast("double")


def reached(ab: Column, bb: Column, ibb: Column, sf: Column, hbp: Column) -> Column:
    """Plate appearances that count for wOBA and on-base percentage."""
    return ab + bb - ibb + sf + hbp


def weighted_on_base(c, bb: Column, hbp: Column, singles: Column, doubles: Column, triples: Column, hr: Column) -> Column:
    """Sum of the season's run weights; ``c`` gives a constant's column by name."""
    return c("w_bb") * bb + c("w_hbp") * hbp + c("w_1b") * singles + c("w_2b") * doubles + c("w_3b") * triples + c("w_hr") * hr


def woba(c, bb, hbp, hr, singles, doubles, triples, ibb, ab, sf) -> Column:
    total = weighted_on_base(c, bb, hbp, singles, doubles, triples, hr)
    return _guarded(ab, F.try_divide(total, _double(reached(ab, bb, ibb, sf, hbp))))


def wrc_plus(c, woba_: Column, pa: Column) -> Column:
    return _guarded(pa, (woba_ - c("woba")) / c("woba_scale") + c("r_per_pa") * pa)


def on_base(bb, hbp, singles, doubles, triples, hr, ab, ibb, sf) -> Column:
    return _guarded(ab, F.try_divide(_double(bb + hbp + singles + doubles + triples + hr), reached(ab, bb, ibb, sf, hbp)))


def slugging(singles, doubles, triples, hr, ab) -> Column:
    return _guarded(ab, F.try_divide(_double(singles + 2 * doubles + 3 * triples + 4 * hr), ab))


def on_base_plus_slugging(obp: Column, slg: Column) -> Column:
    return F.when((obp == 0) | (slg == 0), 0.0).otherwise(obp + slg)


def batting_babip(h, hr, ab, k, sf) -> Column:
    """Null where its denominator is 0."""
    return _guarded(ab, F.try_divide(_double(h - hr), ab - k - sf - hr))


def batting_home_run_rate(hr, fb) -> Column:
    return _guarded(fb, F.try_divide(_double(hr), fb))


def fip(c, bb, hbp, hr, k, ip) -> Column:
    return _guarded(ip, F.try_divide(_double(13 * hr + 3 * (bb + hbp) - 2 * k), ip) + c("c_fip"))


def xfip(c, bb, hbp, k, ip, fb, league_hr, league_fb) -> Column:
    expected = 13 * (fb * F.try_divide(_double(league_hr), _double(league_fb)))
    return _guarded(ip, F.try_divide(expected + 3 * (bb + hbp) - 2 * k, ip) + c("c_fip"))


def pitching_babip(h, hr, ab, k, sf) -> Column:
    low = ab - k - hr + sf
    return F.when((ab == 0) | (low == 0), 0.0).otherwise(F.try_divide(_double(h - hr), low))


def pitching_home_run_rate(hr, fb) -> Column:
    """In percent."""
    return _guarded(fb, F.try_divide(_double(hr), fb) * 100)


def fielding_runs(assists, errors, chances) -> Column:
    return _guarded(chances, F.try_divide(_double(assists + errors), chances))


def innings(text: Column) -> Column:
    """Innings as a decimal number as written; blank or other text is 0."""
    return F.coalesce(F.trim(text).try_cast("double"), F.lit(0.0))


def share(of: Column, base: Column, places: int) -> Column:
    """of / base where base is positive, else null."""
    return F.when(base > 0, rounded(_double(of) / _double(base), places))
