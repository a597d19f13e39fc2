"""Training-data operators: search, language, fixity, packing, joins, decontamination, chat, toxicity, shards, HTML."""
