"""Training-data operators: language ID, token files, packing, exact top-k, licence
lookup, chat rendering, personal data, SimHash near-duplicates, decontamination
and toxicity.  Nothing outside this package imports it."""
