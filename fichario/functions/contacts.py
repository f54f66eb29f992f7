"""E-mail and phone functions (C1-C4) and the choice of contact channel."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fichario import constants as K
from fichario.functions.text import digits, strip


def _has_at(email: Column) -> Column:
    return F.coalesce(F.contains(email, F.lit("@")), F.lit(False))


def email_normalized(email: Column) -> Column:
    return F.when(_has_at(email), F.lower(strip(email)))


def email_domain(email: Column) -> Column:
    """Text after the last ``@``, NULL without one."""
    return F.substring_index(email_normalized(email), "@", -1)


def is_free_domain(domain: Column) -> Column:
    return F.coalesce(F.lower(domain).isin(*K.FREE_EMAIL_DOMAINS), F.lit(False))


def email_kind(email: Column) -> Column:
    """``invalido``, ``gratuito`` or ``corporativo``."""
    return (
        F.when(~_has_at(email), F.lit("invalido"))
        .when(email_domain(email).isin(*K.FREE_EMAIL_DOMAINS), F.lit("gratuito"))
        .otherwise(F.lit("corporativo"))
    )


def email_role(email: Column) -> Column:
    """Role told by the local part (before the first ``@``); first matching rule wins."""
    local = F.when(_has_at(email), F.lower(F.substring_index(email, "@", 1)))
    return (
        F.when(F.coalesce(local, F.lit("")) == "", "unknown")
        .when(local.rlike("^(" + "|".join(K.ACCOUNTING_PREFIXES) + ")"), "accounting")
        .when(local.isin(*K.FINANCE_WORDS), "finance")
        .when(local.isin(*K.SALES_WORDS), "sales")
        .when(local.isin(*K.SUPPORT_WORDS), "support")
        .when(local.rlike(r"^[a-z]+\.[a-z]+$"), "personal")
        .otherwise("general")
    )


def normalize_phone(raw: Column) -> Column:
    """Brazilian number with country code 55, NULL when it cannot be one.

    A chain of patterns in which each step uses the one before once, so the expression stays small
    inside the array functions over links.
    """
    number = F.regexp_replace(digits(raw), "^00", "")
    number = F.regexp_replace(number, "^(?!55)([0-9]{10,11})$", "55$1")
    areas = "|".join(K.AREA_CODES)
    # Country code, area code, 8 or 9 digits that are not one digit repeated.
    valid = rf"^(55(?:{areas})(?!([0-9])\2+$)[0-9]{{8,9}})$"
    return F.nullif(F.regexp_extract(number, valid, 1), F.lit(""))


def whatsapp_candidate(phone: Column) -> Column:
    """C4: link built from a registry phone; a candidate only, never a confirmed contact."""
    return F.concat(F.lit("https://wa.me/"), normalize_phone(phone))


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def contact_channel(
    email: Column,
    email_type: Column,
    whatsapp_valid: Column,
    whatsapp_number: Column,
    whatsapp_url: Column,
    phone: Column,
    phone_candidate: Column,
    instagram: Column,
) -> Column:
    """Best channel as STRUCT(channel, value, confidence, role); first matching rule wins."""
    address = strip(_text(email))
    role = email_role(address)
    corporate = (_text(email_type) == "corporativo") & (address != "")
    number = _text(whatsapp_number)
    phone_value = strip(_text(phone))
    confirmed_url = F.when(_text(whatsapp_url) != "", whatsapp_url).otherwise(
        F.concat(F.lit("https://wa.me/"), number)
    )

    def choice(channel: str | None, value: Column, confidence, contact_role) -> Column:
        return F.struct(
            F.lit(channel).cast("string").alias("channel"),
            value.cast("string").alias("value"),
            (F.lit(confidence) if isinstance(confidence, int) else confidence).alias("confidence"),
            (F.lit(contact_role) if isinstance(contact_role, str) else contact_role).alias("role"),
        )

    outreach_confidence = F.when(role == "sales", 85).otherwise(75)
    return (
        F.when(
            corporate & role.isin("sales", "support", "general"),
            choice("email_corporativo", address, outreach_confidence, role),
        )
        .when(
            F.coalesce(whatsapp_valid, F.lit(False)) & (number != ""),
            choice("whatsapp_confirmado", confirmed_url, 90, "sales"),
        )
        .when(phone_value != "", choice("telefone_comercial", phone_value, 60, "general"))
        .when(
            corporate & role.isin("finance", "accounting"),
            choice("email_corporativo", address, 40, role),
        )
        .when(
            _text(phone_candidate) != "",
            choice("whatsapp_candidato", phone_candidate, 25, "unknown"),
        )
        .when(_text(instagram) != "", choice("instagram", instagram, 20, "unknown"))
        .otherwise(choice(None, F.lit(None), 0, "unknown"))
    )
