"""Operations of a training-data pipeline: language, tokens, decontamination, mixing, licences, toxicity, dedup."""
