"""Training-data operators: near-duplicates, lines, personal data, search,
mixing, archives, decontamination, chat, page text and language."""
