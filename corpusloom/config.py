"""Settings of a preparation run."""

from __future__ import annotations

from dataclasses import dataclass

from corpusloom.functions.layout import LAYOUTS

# What the settings may be (both ends included, None is open).
CHOICES = {"source": ("catalog", "files"), "layout": LAYOUTS,
           "on_unknown": ("error", "null", "drop")}
RANGES = {
    "validation_percent": (0, 50),
    "epochs": (1, None),
    "batch_size": (1, None),
    "accum": (1, None),
    "max_len": (16, None),
    "block_size": (1, None),
    "eval_batches": (1, None),
    "temperature": (0, None),
    "top_p": (0, 1),
    "top_k": (1, None),
}


@dataclass(frozen=True)
class PrepConfig:
    source: str = "catalog"
    root: str | None = None
    name: str | None = None
    config: str | None = None
    path: str | None = None
    schema: str | None = None       # of JSON and CSV files, else it is inferred
    multiline: bool = False         # CSV with line breaks in quotes
    split: str | None = None        # of a catalog table
    validation_percent: float = 5.0
    layout: str = "auto"
    text_field: str | None = None
    prompt_field: str | None = None
    response_field: str | None = None
    conversation_field: str | None = None
    style: str = "manual"
    eos: str | None = "</s>"
    key: str = "row_id"
    batch_size: int = 1
    accum: int = 8
    max_len: int = 256
    vocab_size: int = 50_000
    on_unknown: str = "error"       # of characters that a vocabulary lacks
    epochs: int = 2
    seed: int = 42
    block_size: int = 256
    eval_batches: int = 50
    temperature: float = 0.7
    top_p: float = 0.9
    top_k: int = 20
    repetition_penalty: float = 1.1
    clean: bool = False

    def errors(self) -> list[str]:
        """Everything that is wrong, not just the first thing."""
        found = [f"{name}={getattr(self, name)!r} is not one of {', '.join(allowed)}"
                 for name, allowed in CHOICES.items() if getattr(self, name) not in allowed]
        needed = {"catalog": ("root", "name"), "files": ("path",)}.get(self.source, ())
        missing = [name for name in needed if not getattr(self, name)]
        if missing:
            found.append(f"source {self.source!r} needs {' and '.join(missing)}")
        if self.source == "files" and self.split not in (None, "train"):
            found.append(f"split={self.split!r}: files are all of the split 'train'")
        for name, (low, high) in RANGES.items():
            value = getattr(self, name)
            if value < low or (high is not None and value > high):
                found.append(f"{name}={value} is outside {low} to {'any' if high is None else high}")
        if self.repetition_penalty <= 0:
            found.append(f"repetition_penalty={self.repetition_penalty} is not above 0")
        return found

    def validate(self) -> "PrepConfig":
        errors = self.errors()
        if errors:
            raise ValueError("invalid settings:\n" + "\n".join(
                f"  {i}. {e}" for i, e in enumerate(errors, 1)))
        return self
