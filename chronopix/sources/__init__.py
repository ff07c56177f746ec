"""Where observations come from: products, masks, regions, tables of features and tiles."""
