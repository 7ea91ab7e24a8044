"""Operators of a training-data pipeline: deduplication, quality, language
modelling, tokenised output, archives, licences, decontamination, packing and
toxicity.  Nothing else in the library imports this subpackage."""
