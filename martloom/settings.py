"""Names, codes, patterns and formats that the CRM and its reports define."""

# Cell contents with a special meaning.
UNSELECTED = "non sélectionné"
ZERO_DATE = "0000-00-00 00:00:00"
EURO_MARK = "|EUR"
BYTE_ORDER_MARK = "\ufeff"
LIST_SEPARATOR = ", "
NULL_IN_LIST = "None"

# Patterns.
INTEGER_TEXT = "^-?[0-9]+$"
OFFSET_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\+\d{2}:\d{2}$"
PLAIN_DATE = r"^\d{4}-\d{2}-\d{2}$"
ANY_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"

# First and last year a timestamp may have.
FIRST_YEAR, LAST_YEAR = 1677, 2262

# Limits of a 32-bit integer column.
INT_MIN, INT_MAX = -2147483648, 2147483647

# Field types that express a relation to another record.
RELATION_TYPES = ["crm", "crm_entity", "iblock_section", "iblock_element"]

# Prefix of the nested property fields, and the key of their value.
PROPERTY_PREFIX = "PROPERTY_"
PROPERTY_KEY = "value"

# The entity type of invoices, which the type catalogue does not list.
INVOICE_TYPE = 31

# Key of every stored table.
TABLE_KEYS = {
    "crm_lead": "ID", "crm_lead_uf": "LEAD_ID", "entity_lead": "entity_lead_ID",
    "crm_deal": "ID", "crm_deal_uf": "DEAL_ID", "entity_deal": "entity_deal_ID",
    "crm_contact": "ID", "crm_contact_uf": "CONTACT_ID", "entity_contact": "entity_contact_ID",
    "crm_company": "ID", "crm_company_uf": "COMPANY_ID", "entity_company": "entity_company_ID",
}

# Columns a secondary table keeps although its base table has them too.
KEPT_SHARED = {
    "contact": ["ID", "ID_CONTACT"],
    "deal": ["ID", "DEAL_ID"],
    "lead": ["ID", "LEAD_ID"],
    "company": ["ID", "COMPANY_ID"],
}

# Custom fields on a contact that mark a role.
CONTACT_FLAGS = {
    "emergency_contact": "UF_CRM_1643183509",
    "legal_guardian_1": "UF_CRM_1606994316",
    "legal_guardian_2": "UF_CRM_1606994331",
    "payer_1": "UF_CRM_1604401780",
    "payer_2": "UF_CRM_1604401811",
}

# Relation columns of a deal that hold a contact id.
DEAL_ROLES = {
    "employer_contact": "sql_UF_CRM_1589207602",
    "tutor": "sql_UF_CRM_1588240383",
    "tutor_2": "sql_UF_CRM_1602495367",
    "accountant": "sql_UF_CRM_1591262278",
}

# Relation columns of a company that hold a contact id.
COMPANY_ROLES = {
    "director": "sql_UF_CRM_1589375441",
    "funder_contact": "sql_UF_CRM_1589375694",
    "recruiter": "sql_UF_CRM_1589355778",
}

# Deal category codes.
DEAL_CATEGORIES = {
    "deals_apprentice": 8,
    "deals_initial": 4,
    "deals_employer": 10,
    "deals_continuing": 42,
    "deals_funding": 20,
}

# Columns an enriched lead takes from its contact and its deal, with their new names.
LEAD_FROM_CONTACT = {
    "EMAIL": "Contacts_EMAIL",
    "SOURCE_DESCRIPTION": "Contact_Source_Description",
}
LEAD_FROM_DEAL = {
    "SOURCE_NAME": "Transactions_SOURCE_NAME",
    "SOURCE_DESCRIPTION": "Transaction_Source_Description",
    "UF_CRM_5E5634910DD58": "UF_CRM_5E5634910DD58",
    "UF_CRM_1591275382": "UF_CRM_1591275382",
    "UF_CRM_5FA697664B231": "UF_CRM_5FA697664B231",
    "UF_CRM_6341774C87D94": "UF_CRM_6341774C87D94",
}

# Entity tables that are dropped and recreated on every run.
RECREATED = ["deal", "contact", "lead", "company"]

# Tables the connector delivers, in loading order.
CONNECTOR_TABLES = [
    "crm_lead", "crm_lead_uf", "crm_deal", "crm_deal_uf",
    "crm_contact", "crm_contact_uf", "crm_company", "crm_company_uf",
]

# Owner type of the product rows that belong to a smart entity table.
PRODUCT_ROW_OWNERS = {"entity_140": "T8c", "entity_160": "Ta0"}

# Columns left out when a table is loaded, by table.
EXCLUDED_COLUMNS = {
    "crm_deal_uf": ["UF_CRM_1611039011", "UF_CRM_5FA5304C6E73B", "UF_CRM_1691245430"],
}

# Columns kept of an invoice, in this order.
INVOICE_COLUMNS = [
    "id", "xmlId", "title", "createdBy", "updatedBy", "movedBy",
    "createdTime", "updatedTime", "movedTime", "categoryId", "opened", "stageId",
    "previousStageId", "begindate", "closedate", "companyId", "contactId", "opportunity",
    "isManualOpportunity", "taxValue", "currencyId", "mycompanyId", "sourceId", "sourceDescription",
    "webformId", "ufCrmSmartInvoiceModeDePaiement", "ufCrmSmartInvoiceFactureSage",
    "ufCrmSmartInvoiceTypeDeFacture", "ufCrmSmartInvoiceNiveauRelanceEffectue",
    "ufCrmSmartInvoiceDateRejetPrelevement", "ufCrmSmartInvoiceDerniereDateRelance",
    "ufCrm_SMART_INVOICE_1696253565425", "ufCrmModifyById", "ufCrmCreatedById", "ufCrmOrderIds",
    "ufCrmIsRepeatedApproach", "ufCrmIsReturnCustomer", "ufCrmClosed", "ufCrmOriginId",
    "ufCrmOriginatorId", "ufCrmDateCreate", "ufCrmEventDate", "ufCrmDateModify",
    "ufCrmEventDescription", "ufCrmProbability", "ufCrmLeadId", "ufCrmTrackingSourceId",
    "ufCrmTypeId", "ufCrmEventId", "ufCrm_61DC467EDA04F", "ufCrm_61DC467DE99B3",
    "ufCrm_61DFD81AC65E3", "ufCrm_664F54B5C46B3", "ufCrm_61DC4678BB899", "ufCrm_61DC46784EB7A",
    "ufCrm_1640156110", "ufCrm_623C3609893FB", "ufCrm_61DC467C4241A", "ufCrm_65093FB654AC9",
    "ufCrm_5FA697664B231", "ufCrm_660FB482ADBB2", "ufCrm_652902CA0E3C7", "ufCrm_1621501802",
    "ufCrm_61DC467E0E3E4", "ufCrm_6319D6B41548D", "ufCrm_652902CDD8B2D", "ufCrm_64A2739CB7701",
    "ufCrm_6356348D028FB", "ufCrm_6650655718598", "ufCrm_1662630245369", "ufCrm_62175488184F1",
    "ufCrm_1645694434", "ufCrm_62174CD9B8BD8", "ufCrm_1645693993", "ufCrm_1677573429",
    "ufCrm_63FDDE6864121", "ufCrm_1685008181", "ufCrm_646F3F4653817", "ufCrm_1677574165",
    "ufCrm_63FDDE68A7E6F", "ufCrm_623C4B8BE9CE3", "ufCrm_61DC46794753B", "ufCrm_61DC467941032",
    "ufCrm_1588239789", "ufCrm_1588239773", "ufCrm_61DC4678C23DE", "ufCrm_61DC4678C8CB0",
    "ufCrm_61DC467A24250", "parentId2",
]
