"""Plans: the TF-IDF model, flavors and plan inspection."""
