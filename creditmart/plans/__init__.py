"""The datamart's stages: what each layer's tables are made of, and the jobs that write them."""
