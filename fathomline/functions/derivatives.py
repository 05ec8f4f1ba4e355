"""Derivatives of Column expressions by forward mode: a number carries its derivatives along, and each operation applies its rule to them."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import number


class Dual:
    """A value and its derivatives by parameter; a parameter that isn't named has none."""

    def __init__(self, value, parts: dict[str, Column] | None = None):
        self.value, self.parts = number(value), parts or {}

    @classmethod
    def parameter(cls, name: str, value) -> Dual:
        return cls(value, {name: F.lit(1.0)})

    def _with(self, value: Column, *terms: tuple[Dual, Column]) -> Dual:
        """value, whose derivatives are the terms' ones times their factors, added up."""
        parts: dict[str, Column] = {}
        for dual, factor in terms:
            for name, d in dual.parts.items():
                parts[name] = parts[name] + d * factor if name in parts else d * factor
        return Dual(value, parts)

    def __add__(self, other) -> Dual:
        other = as_dual(other)
        return self._with(self.value + other.value, (self, F.lit(1.0)), (other, F.lit(1.0)))

    def __mul__(self, other) -> Dual:
        other = as_dual(other)
        return self._with(self.value * other.value, (self, other.value), (other, self.value))

    def __truediv__(self, other) -> Dual:
        other = as_dual(other)
        inverse = F.try_divide(F.lit(1.0), other.value)
        return self._with(self.value * inverse, (self, inverse), (other, -self.value * inverse * inverse))

    def __neg__(self) -> Dual:
        return self * -1.0

    def __sub__(self, other) -> Dual:
        return self + -as_dual(other)

    def __radd__(self, other) -> Dual:
        return self + other

    def __rmul__(self, other) -> Dual:
        return self * other

    def __rsub__(self, other) -> Dual:
        return as_dual(other) - self

    def _by(self, f: Callable[[Column], Column], slope: Callable[[Column], Column]) -> Dual:
        return self._with(f(self.value), (self, slope(self.value)))

    def sin(self) -> Dual:
        return self._by(F.sin, F.cos)

    def cos(self) -> Dual:
        return self._by(F.cos, lambda x: -F.sin(x))

    def sqrt(self) -> Dual:
        return self._by(F.sqrt, lambda x: F.try_divide(F.lit(0.5), F.sqrt(x)))


def as_dual(x) -> Dual:
    return x if isinstance(x, Dual) else Dual(x)


def jacobian(outputs: dict[str, Dual], parameters: Iterable[str]) -> dict[str, Column]:
    """A column d<output>_d<parameter> for each pair; 0 where an output doesn't depend on a parameter."""
    return {f"d{o}_d{p}": dual.parts.get(p, F.lit(0.0)) for o, dual in outputs.items() for p in parameters}
