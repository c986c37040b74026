"""Writers for finished index documents."""
