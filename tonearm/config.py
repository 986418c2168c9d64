"""Pipeline parameters (the reference keeps them in a YAML file)."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    # preprocessing
    min_user_interactions: int = 5
    min_artist_listeners: int = 3
    test_size: float = 0.2
    alpha: float = 40.0
    seed: int = 42
    # model
    factors: int = 100
    regularization: float = 0.01
    iterations: int = 20
    # serving / evaluation
    top_k: int = 10
    eval_k: int = 10
    charts_k: int = 20
    mood_users: int = 50
    # physical knobs
    split_bucket_digits: int = 4          # hex digits of the md5 key used to salt W1
