"""Training-data operators (near-duplicates, licences, mixing, decontamination,
language-model scores, embeddings, personal data, chat, quality, toxicity).

Nothing outside this folder imports it; ``registry`` lists its queries.
"""
