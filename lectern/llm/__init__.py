"""Operations of a training-data pipeline: search, deduplication, formatting, mixing, filters, tokens, quality, licences."""
