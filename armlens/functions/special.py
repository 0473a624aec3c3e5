"""Special functions as SQL expressions, so that they stay in generated code and can be checked in another engine."""

from __future__ import annotations

# W. J. Cody's rational approximations of erf and erfc (1969), in the order of rising coefficients' use.
_A = [1.85777706184603153e-1, 3.16112374387056560e0, 1.13864154151050156e2, 3.77485237685302021e2, 3.20937758913846947e3]
_B = [1.0, 2.36012909523441209e1, 2.44024637934444173e2, 1.28261652607737228e3, 2.84423683343917062e3]
_C = [2.15311535474403846e-8, 5.64188496988670089e-1, 8.88314979438837594e0, 6.61191906371416295e1, 2.98635138197400131e2, 8.81952221241769090e2, 1.71204761263407058e3, 2.05107837782607147e3, 1.23033935479799725e3]
_D = [1.0, 1.57449261107098347e1, 1.17693950891312499e2, 5.37181101862009858e2, 1.62138957456669019e3, 3.29079923573345963e3, 4.36261909014324716e3, 3.43936767414372164e3, 1.23033935480374942e3]
_P = [1.63153871373020978e-2, 3.05326634961232344e-1, 3.60344899949804439e-1, 1.25781726111229246e-1, 1.60837851487422766e-2, 6.58749161529837803e-4]
_Q = [1.0, 2.56852019228982242e0, 1.87295284992346725e0, 5.27905102951428412e-1, 6.05183413124413191e-2, 2.33520497626869185e-3]
# Lanczos' approximation of the gamma function, g = 7.
_LANCZOS = [0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059, 12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7]


def _number(c: float) -> str:
    return f"{c!r}" if "e" in repr(c) else f"{c!r}e0"


def _horner(coefficients: list[float], x: str) -> str:
    out = _number(coefficients[0])
    for c in coefficients[1:]:
        out = f"({out} * {x} + {_number(c)})"
    return out


def erfc_sql(x: str) -> str:
    """erfc(x) for x >= 0, to about 1e-15."""
    y, y2, r2 = f"({x})", f"(({x}) * ({x}))", f"(1e0 / (({x}) * ({x})))"
    small = f"1e0 - {y} * {_horner(_A, y2)} / {_horner(_B, y2)}"
    middle = f"exp(-{y2}) * {_horner(_C, y)} / {_horner(_D, y)}"
    large = f"exp(-{y2}) / {y} * (0.5641895835477562869e0 - {r2} * {_horner(_P, r2)} / {_horner(_Q, r2)})"
    return f"(CASE WHEN {y} <= 0.46875e0 THEN {small} WHEN {y} <= 4e0 THEN {middle} ELSE {large} END)"


def two_sided_normal_sql(z: str) -> str:
    """P(|Z| >= |z|)."""
    return f"least(1e0, {erfc_sql(f'abs({z}) * 0.70710678118654752440e0')})"


def lgamma_sql(x: str) -> str:
    """log(gamma(x)) for x >= 1."""
    z = f"(({x}) - 1e0)"
    total = " + ".join([_number(_LANCZOS[0]), *[f"({_number(c)}) / ({z} + {k}e0)" for k, c in enumerate(_LANCZOS[1:], 1)]])
    t = f"({z} + 7.5e0)"
    return f"(0.91893853320467274178e0 + ({z} + 0.5e0) * ln({t}) - {t} + ln({total}))"


def round_digits_sql(x: str, digits: int = 9) -> str:
    """A rounded double: sums of doubles may differ in their last bits from run to run."""
    return f"round({x}, {digits})"
