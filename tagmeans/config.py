"""Clustering settings and their validation (operator W2, static part)."""

from __future__ import annotations

from dataclasses import dataclass, replace

# The default language list, in the order that defines the
# language index (index 0 = JavaScript).
DEFAULT_LANGS: tuple[str, ...] = (
    "JavaScript", "Java", "PHP", "Python", "C#", "C++", "Ruby", "CSS",
    "Objective-C", "Perl", "Scala", "Haskell", "MATLAB", "Clojure", "Groovy",
)

# Default k-means settings.
DEFAULT_LANG_SPREAD = 50000
DEFAULT_KERNELS = 45
DEFAULT_ETA = 20.0
DEFAULT_MAX_ITERATIONS = 120

# At or above this spread the seeds are drawn per language, below it globally.
STRATIFIED_MIN_SPREAD = 500


@dataclass(frozen=True)
class ClusterConfig:
    """Everything the reference lets a user override, plus our own knobs.

    ``seed`` fixes the seed draw, ``on_unknown`` decides what happens to a
    scored question whose tag is missing or not in ``langs`` ('error' raises,
    'drop' filters the row out).
    """

    langs: tuple[str, ...] = DEFAULT_LANGS
    lang_spread: int = DEFAULT_LANG_SPREAD
    kernels: int = DEFAULT_KERNELS
    eta: float = DEFAULT_ETA
    max_iterations: int = DEFAULT_MAX_ITERATIONS
    seed: int = 42
    on_unknown: str = "error"

    def __post_init__(self) -> None:
        object.__setattr__(self, "langs", tuple(self.langs))
        if not self.langs:
            raise ValueError("langs must not be empty")
        if len(set(self.langs)) != len(self.langs):
            raise ValueError("langs must not contain duplicates")
        if self.lang_spread <= 0:
            raise ValueError(
                f"lang_spread is {self.lang_spread}; it has to be above 0 so that x / lang_spread "
                "is the language")
        if self.kernels <= 0:
            raise ValueError("kernels must be positive")
        if self.kernels % len(self.langs) != 0:
            raise ValueError(
                f"{self.kernels} kernels can't be shared out evenly among "
                f"{len(self.langs)} languages")
        if self.max_iterations < 1:
            raise ValueError("max_iterations must be at least 1")
        if self.on_unknown not in ("error", "drop"):
            raise ValueError("on_unknown must be 'error' or 'drop'")

    @property
    def per_lang(self) -> int:
        return self.kernels // len(self.langs)

    @property
    def stratified(self) -> bool:
        """True when seeds are drawn per language (spread >= 500)."""
        return self.lang_spread >= STRATIFIED_MIN_SPREAD

    def with_(self, **changes) -> "ClusterConfig":
        return replace(self, **changes)
