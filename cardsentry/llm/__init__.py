"""Operations of training-data pipelines: duplicates, licences, mixing, chat, subword, personal data, archives, quality."""
