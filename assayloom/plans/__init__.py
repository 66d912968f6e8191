"""Operators composed into whole enrichment and modelling flows."""

from assayloom.plans.compounds import build_compound_dimension
from assayloom.plans.enrich import enrich_prediction, enrich_training
from assayloom.plans.modelframe import build_model_frame
from assayloom.plans.overview import profile

__all__ = [
    "build_compound_dimension", "build_model_frame", "enrich_prediction", "enrich_training", "profile",
]
