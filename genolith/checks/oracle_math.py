"""Special functions as SQL text for the oracles."""

from genolith.functions import special as sp


def poly(x: str, coefficients: list[float]) -> str:
    text = f"{coefficients[-1]!r}e0" if "e" not in repr(coefficients[-1]) else repr(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        c = repr(c) if "e" in repr(c) else f"{c!r}e0"
        text = f"({text} * {x} + {c})"
    return text


def erfc(x: str) -> str:
    """For x >= 0."""
    sq = f"({x}) * ({x})"
    return (
        f"(CASE WHEN {x} <= 46875e-5 THEN 1 - ({x}) * {poly(sq, sp.ERF_NUM)} / {poly(sq, sp.ERF_DEN)} "
        f"WHEN {x} <= 4 THEN exp(-{sq}) * {poly(f'({x})', sp.ERFC_MID_NUM)} / {poly(f'({x})', sp.ERFC_MID_DEN)} "
        f"ELSE exp(-{sq}) / ({x}) * (1 / sqrt(pi()) - 1 / ({sq}) * {poly(f'(1 / ({sq}))', sp.ERFC_TAIL_NUM)} / {poly(f'(1 / ({sq}))', sp.ERFC_TAIL_DEN)}) END)"
    )


def two_sided(z: str) -> str:
    return erfc(f"(abs({z}) / sqrt(2e0))")


def normal_quantile(p: str) -> str:
    """For 0 < p < 1."""
    q, tail = f"({p} - 5e-1)", f"sqrt(-ln(CASE WHEN {p} < 5e-1 THEN {p} ELSE 1 - {p} END))"
    centre = f"(180625e-6 - {q} * {q})"
    near, far = f"({tail} - 16e-1)", f"({tail} - 5)"
    side = (f"CASE WHEN {tail} <= 5 THEN {poly(near, sp.PPND_C)} / {poly(near, sp.PPND_D)} "
            f"ELSE {poly(far, sp.PPND_E)} / {poly(far, sp.PPND_F)} END")
    return (f"(CASE WHEN abs({q}) <= 425e-3 THEN {q} * {poly(centre, sp.PPND_A)} / {poly(centre, sp.PPND_B)} "
            f"WHEN {q} < 0 THEN -({side}) ELSE {side} END)")
