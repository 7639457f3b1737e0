"""Part of paperloom; see the README for what lives here."""
